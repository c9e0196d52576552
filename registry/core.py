"""Ties jobs, inputs and SQL together."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType

from registry.fixtures import BASE, Dialect, sources
from tidemill.functions.dates import shift
from tidemill.session import prepare

_SPARK_SOURCES = sources(Dialect(spark=True))
_DUCK_SOURCES = sources(Dialect(spark=False))

_CLOCKS = {"order": ("orders", "o_orderdate"), "event": ("events", "ts")}
Job = Callable[["Tables", str], DataFrame]


class Tables(Mapping):
    """Lazy name -> DataFrame: given tables, inputs derived from them, and the results of registered jobs."""

    jobs: dict[str, tuple[Job, str]] = {}

    def __init__(self, spark: SparkSession, sf_dir: str, extra: Mapping[str, DataFrame] | None = None):
        self.spark, self.sf_dir = prepare(spark), sf_dir
        self._dates: dict[str, str] = {}
        self._extra = dict(extra or {})

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def d(self, clock: str) -> str:
        """Run date of a clock: the last order day or the last event day, one aggregated value."""
        if clock not in self._dates:
            table, col = _CLOCKS[clock]
            last: dt.datetime = self.given(table).agg(F.max(col).alias("m")).first().m
            self._dates[clock] = last.date().isoformat()
        return self._dates[clock]

    def first(self, clock: str) -> str:
        """First day of a clock."""
        table, col = _CLOCKS[clock]
        return self.given(table).agg(F.min(col).alias("m")).first().m.date().isoformat()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._extra:
            self._extra[name] = self._build(name)
        return self._extra[name]

    def _build(self, name: str) -> DataFrame:
        if name in BASE:
            return self.given(name)
        if name in _SPARK_SOURCES:
            text = _SPARK_SOURCES[name]
            used = {b: self.given(b) for b in BASE if "{" + b + "}" in text}
            return self.spark.sql(text, **used)
        if name in self.jobs:
            job, clock = self.jobs[name]
            return job(self, self.d(clock))
        raise KeyError(name)

    def with_tables(self, **extra: DataFrame) -> "Tables":
        return Tables(self.spark, self.sf_dir, {**self._extra, **extra})

    def __iter__(self) -> Iterator[str]:
        return iter([*BASE, *_SPARK_SOURCES, *self.jobs])

    def __len__(self) -> int:
        return len(BASE) + len(_SPARK_SOURCES) + len(self.jobs)


def finished(df: DataFrame) -> DataFrame:
    """Money leaves as double: exact decimals inside, one conversion at the very end."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        out.append(c.cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else c)
    return df.select(*out)


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}
        self.tables: dict[str, str] = {}  # named SQL building blocks

    def job(self, key: str, fn: Job, clock: str, sql: str | None = None, table: str | None = None,
            final: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Register a job under a query key; ``table`` also makes its result an input of later jobs."""
        name = table or fn.__name__
        Tables.jobs.setdefault(name, (fn, clock))

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            t = Tables(spark, sf_dir)
            df = fn(t, t.d(clock))
            return finished(final(df) if final else df)

        self.queries[key] = run
        if sql is not None:
            self.sql[key] = sql

    def query(self, key: str, fn: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
        self.queries[key] = lambda spark, sf_dir: finished(fn(Tables(spark, sf_dir)))
        if sql is not None:
            self.sql[key] = sql

    def oracle(self) -> dict[str, str]:
        return {k: self.compose(v) for k, v in self.sql.items()}

    def compose(self, text: str) -> str:
        """Prefix a statement with the building blocks it names, in dependency order."""
        text = _dates(text)
        done: dict[str, str] = {}
        self._collect(text, done)
        body = ",\n".join(f"{n} as ({s})" for n, s in done.items())
        if not done:
            return text
        head = re.match(r"\s*with\s+", text, re.I)
        return f"with {body},\n{text[head.end():]}" if head else f"with {body}\n{text}"

    def _block(self, name: str) -> str | None:
        if name in self.tables:
            return _dates(self.tables[name])
        if name in _DUCK_SOURCES:
            return re.sub(r"\{(\w+)\}", r"\1", _DUCK_SOURCES[name])
        if name in _RUN:
            return _RUN[name]
        return None

    def _collect(self, text: str, done: dict[str, str]) -> None:
        for name in dict.fromkeys(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", text)):
            if name in done:
                continue
            block = self._block(name)
            if block is not None:
                self._collect(block, done)
                done[name] = block


def _run_dates(expr: str, table: str) -> str:
    f = "strftime(cast(m as date) - {}, '%Y-%m-%d') as {}"
    cols = ", ".join(f.format(n, name) for name, n in (("d", 0), ("y", 1), ("d7", 6), ("d30", 29), ("w", 7)))
    return f"select {cols} from (select max({expr}) as m from {table})"


_RUN = {"run_order": _run_dates("o_orderdate", "orders"), "run_event": _run_dates("ts", "events")}


def _dates(text: str) -> str:
    """``{O.d7}`` -> first day of the last seven of the order clock, ``{E.d}`` -> last event day, ..."""
    return re.sub(r"\{([OE])\.(\w+)\}",
                  lambda m: f"(select {m[2]} from run_{'order' if m[1] == 'O' else 'event'})", text)


def half_up(num: str, den: str, scale: int = 2) -> str:
    """num/den rounded half up in integer arithmetic (non-negative, at most four decimals); null for den = 0."""
    n, d = f"cast(({num}) * 10000 as hugeint)", f"cast(({den}) * 10000 as hugeint)"
    return (f"case when ({den}) = 0 then null else "
            f"cast(({n} * {2 * 10 ** scale} + {d}) // (2 * {d}) as double) / {10 ** scale} end")


REG = Registry()


def yesterday(t: Tables, clock: str) -> str:
    return shift(t.d(clock), -1)
