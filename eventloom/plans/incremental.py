"""Features of a growing table, kept up to date day by day instead of being computed anew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.timeparts import gap_seconds, micros
from eventloom.operators.features import Feature
from eventloom.operators.ordered import Ordered, ordered_columns

#: Kinds of features that the state can carry on; a variance would need more than sums to equal a single run in its last digits.
KINDS = ("size", "non_null", "mean", "distinct", "running_count", "next_gap", "previous_gap")


class FeatureState:
    """The state of some features below ``folder`` (shared by all executors), one version for each day added.

    ``add(rows)`` takes the rows of the next day (later than all rows before, in ``order``) and

    * finds their previous click and running count from the last row and the number of rows that the state keeps for each key, so
      no earlier row is read again;
    * closes the gaps of earlier rows that waited for a next click: the last row of each key is *pending* until its
      key appears again, and then a record (row, next time) is appended;
    * adds the day's sizes, sums and distinct values, combined by key, to those of the state.

    ``features()`` joins rows, late closings and sums; its result equals one run of
    :func:`eventloom.operators.features.add_features` over all days.

    A version consists of written tables and becomes the current one by the last file written (``done``), so a day that fails
    half way is repeated from the version before. Rows and closings are only ever appended in new folders of
    their day. Groups of any size: the neighbours within a day come from :mod:`eventloom.operators.ordered`.

    Defined cases: null keys form a group, as in a single run; a day without rows leaves all values as they are; adding rows
    that are not later than the state's raises; repeated ids are not allowed, since closings name a row by its id.
    """

    def __init__(
        self, spark: SparkSession, folder: str, features: Sequence[Feature], order: Sequence[str] = ("click_time", "click_id")
    ) -> None:
        unknown = sorted({f.kind for f in features} - set(KINDS))
        if unknown:
            raise ValueError(f"features that no state can carry on: {unknown}")
        self.spark, self.folder, self.wanted, self.order = spark, folder.rstrip("/"), list(features), list(order)
        self.time, self.id = self.order[0], self.order[-1]
        # Key lists in another order are walked once.
        self.ordered = sorted({_set(f.keys) for f in features if f.is_ordered})
        self.kinds = [{f.kind for f in features if f.is_ordered and _set(f.keys) == keys} for keys in self.ordered]
        self.summed = sorted({f.keys for f in features if f.kind in ("size", "non_null", "mean")})
        self.distinct = sorted({(f.keys, f.column) for f in features if f.kind == "distinct"})
        # Tables with one row for each key hold the distinct values of a column that is one of the keys.
        held = {_set(k): f"sums{i}" for i, k in enumerate(self.summed)} | {k: f"last{i}" for i, k in enumerate(self.ordered)}
        self.held = [held.get(_set([*keys, column])) for keys, column in self.distinct]

    # --- versions ----------------------------------------------------------------------------------

    def _path(self, version: int, name: str) -> str:
        return f"{self.folder}/{version:06d}/{name}"

    def _exists(self, path: str) -> bool:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)

    def version(self) -> int:
        """Number of days that have been added completely."""
        n = 0
        while self._exists(self._path(n + 1, "done/_SUCCESS")):
            n += 1
        return n

    def _write(self, df: DataFrame, version: int, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self._path(version, name))
        return self.spark.read.schema(df.schema).parquet(self._path(version, name))

    def _read(self, version: int, name: str) -> DataFrame | None:
        return self.spark.read.parquet(self._path(version, name)) if version else None

    # --- one day -----------------------------------------------------------------------------------

    def add(self, rows: DataFrame) -> int:
        """Add the rows of the next day; returns the number of days held."""
        old = self.version()
        new = old + 1
        rows = rows.withColumn("__micros", micros(self.time))
        edge = rows.agg(F.min("__micros"), F.max("__micros")).first()
        last = self._read(old, "done").first()["last"] if old else None
        if edge[0] is not None and last is not None and edge[0] <= last:
            raise ValueError("rows of a new day must be later than all rows of the state")
        for i, keys in enumerate(self.ordered):
            rows = self._walk(rows, keys, i, old, new)
        self._write(rows, new, "rows")
        plain = self._read(new, "rows")
        for i, keys in enumerate(self.summed):
            self._sum(plain, keys, i, old, new)
        for i, (keys, column) in enumerate(self.distinct):
            if self.held[i]:
                continue
            pairs = plain.where(F.col(column).isNotNull()).select(*keys, column)
            before = self._read(old, f"distinct{i}")
            self._write((pairs if before is None else before.unionByName(pairs)).distinct(), new, f"distinct{i}")
        newest = edge[1] if edge[1] is not None else last
        done = self.spark.createDataFrame([(new, newest)], "version int, last long")
        self._write(done, new, "done")
        return new

    def _walk(self, rows: DataFrame, keys: tuple[str, ...], i: int, old: int, new: int) -> DataFrame:
        """The rows with time of the previous and of the next row of their key and the number of rows up to them."""
        held = self._read(old, f"last{i}")
        counted = "running_count" in self.kinds[i]
        more = {"__kept": F.lit(False)} | ({"__rows": F.lit(1).cast("long")} if counted else {})
        now = rows.withColumns(more)
        if held is not None:
            # The last row of each key stands before the day's rows and counts for all that it is the last of.
            names = [*dict.fromkeys([*keys, *self.order, "__micros", *(["__rows"] if counted else [])])]
            missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name not in names]
            now = now.unionByName(held.select(*names, *missing, F.lit(True).alias("__kept")))
        # Every key list needs the next row, to tell the last one; the rows carry on only what features are made of.
        steps = [Ordered("lead", f"__next{i}", "__micros")]
        if "previous_gap" in self.kinds[i]:
            steps.append(Ordered("lag", f"__prev{i}", "__micros"))
        if counted:
            steps.append(Ordered("running_sum", f"__upto{i}", "__rows"))
        walked = self._write(ordered_columns(now, list(keys), self.order, steps), new, f"walk{i}")
        if "next_gap" in self.kinds[i]:
            closed = walked.where(F.col("__kept") & F.col(f"__next{i}").isNotNull())
            self._write(closed.select(self.id, F.col(f"__next{i}").alias("later")), new, f"closed{i}")
        pending = walked.where(F.col(f"__next{i}").isNull())
        upto = [F.col(f"__upto{i}").alias("__rows")] if counted else []
        self._write(pending.select(*dict.fromkeys([*keys, *self.order, "__micros"]), *upto), new, f"last{i}")
        unused = [] if "next_gap" in self.kinds[i] else [f"__next{i}"]
        return walked.where(~F.col("__kept")).drop("__kept", "__rows", *unused)

    def _sum(self, rows: DataFrame, keys: tuple[str, ...], i: int, old: int, new: int) -> None:
        parts = [F.count(F.lit(1)).alias("rows")]
        for f in self.wanted:
            if f.keys == keys and f.kind in ("non_null", "mean"):
                parts.append(F.count(f.column).alias(f"n_{f.name}"))
                if f.kind == "mean":
                    parts.append(F.sum(F.col(f.column).cast("decimal(38,6)" if _whole(rows, f.column) else "double")).alias(f"s_{f.name}"))
        day = rows.groupBy(*keys).agg(*parts)
        before = self._read(old, f"sums{i}")
        if before is not None:
            names = [c for c in day.columns if c not in keys]
            day = before.unionByName(day).groupBy(*keys).agg(*[F.sum(c).cast(day.schema[c].dataType).alias(c) for c in names])
        self._write(day, new, f"sums{i}")

    # --- all days ----------------------------------------------------------------------------------

    def features(self) -> DataFrame:
        """All rows of all days with the wanted features, as of the days held now."""
        days = self.version()
        if not days:
            raise ValueError("no day has been added")
        rows = reduce(DataFrame.unionByName, [self._read(d, "rows") for d in range(1, days + 1)])
        base = [c for c in rows.columns if not c.startswith("__")]
        for i, kinds in enumerate(self.kinds):
            if "next_gap" in kinds:
                closed = reduce(DataFrame.unionByName, [self._read(d, f"closed{i}") for d in range(1, days + 1)])
                rows = rows.join(closed.withColumnRenamed("later", f"__late{i}"), self.id, "left")
        for keys, side in self._sides(days):
            rows = _beside(rows, side, keys)
        out: dict[str, Column] = {}
        for f in self.wanted:
            out[f.name] = self._value(f)
        return rows.select(*base, *[v.alias(n) for n, v in out.items()])

    def _sides(self, days: int) -> list[tuple[tuple[str, ...], DataFrame]]:
        """Key lists with their sums and numbers of distinct values, one row for each key.

        What has fewer keys first joins a table of sums with these keys and others, which has every key of the rows, so that the wide rows are shuffled
        for the longest key lists only.
        """
        sides: dict[tuple[str, ...], DataFrame] = {}

        def add(keys: tuple[str, ...], side: DataFrame) -> None:
            keys = _set(keys)
            sides[keys] = _beside(sides[keys], side, keys) if keys in sides else side

        for i, keys in enumerate(self.summed):
            side = self._read(days, f"sums{i}")
            add(keys, side.select(*keys, *[F.col(c).alias(f"__{i}_{c}") for c in side.columns if c not in keys]))
        whole = set(sides)
        for i, (keys, column) in enumerate(self.distinct):
            pairs = self._read(days, self.held[i] or f"distinct{i}")
            # A value that is one of the keys of its own group is counted once.
            pairs = pairs.where(F.col(column).isNotNull()).select(*dict.fromkeys([*keys, column]))
            add(keys, pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"__distinct{i}")))
        for keys in sorted(sides, key=len):
            wider = [k for k in sorted(whole, key=lambda k: (len(k), k)) if set(keys) < set(k)]
            if wider:
                sides[wider[0]] = _beside(sides[wider[0]], sides.pop(keys), keys)
        return list(sides.items())

    def _value(self, f: Feature) -> Column:
        bits = f.options.get("narrow_bits")
        if f.kind == "distinct":
            value = F.coalesce(F.col(f"__distinct{self.distinct.index((f.keys, f.column))}"), F.lit(0))
            return F.pmod(value, F.lit(2**bits)) if bits else value
        if f.kind in ("size", "non_null", "mean"):
            i = self.summed.index(f.keys)
            if f.kind == "mean":
                return F.col(f"__{i}_s_{f.name}").cast("double") / F.nullif(F.col(f"__{i}_n_{f.name}"), F.lit(0))
            value = F.col(f"__{i}_rows" if f.kind == "size" else f"__{i}_n_{f.name}")
            return F.pmod(value, F.lit(2**bits)) if bits else value
        i = self.ordered.index(_set(f.keys))
        if f.kind == "running_count":
            return F.col(f"__upto{i}") + F.lit(f.options["base"] - 1)
        now = F.col("__micros")
        if f.kind == "next_gap":
            gap = gap_seconds(now, F.coalesce(F.col(f"__next{i}"), F.col(f"__late{i}")), f.options["mode"])
        else:
            pair = (F.col(f"__prev{i}"), now) if f.options["sign"] > 0 else (now, F.col(f"__prev{i}"))
            gap = gap_seconds(*pair, f.options["mode"])
        return gap if f.options["fill"] is None else F.coalesce(gap, F.lit(f.options["fill"]))


def _set(keys: Sequence[str]) -> tuple[str, ...]:
    return tuple(sorted(keys))


def _beside(rows: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of ``side``, which has one row for each of ``keys``; null keys are equal."""
    side = side.withColumnsRenamed({c: f"__k_{c}" for c in keys})
    return rows.join(side, [rows[c].eqNullSafe(side[f"__k_{c}"]) for c in keys], "left").drop(*[f"__k_{c}" for c in keys])


def _whole(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def by_days(state: FeatureState, rows: DataFrame, day: Column) -> FeatureState:
    """Add the rows to the state day after day; the days' names are collected, one small value for each day."""
    named = rows.withColumn("__day", day)
    for (one,) in sorted(tuple(r) for r in named.select("__day").distinct().collect()):
        state.add(named.where(F.col("__day") == F.lit(one)).drop("__day"))
    return state
