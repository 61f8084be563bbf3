"""Feature preparation: split, mode imputation, one-hot encoding and its
inverse, alignment of a new month's columns to the training columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A wide table has a column per level, so its levels must fit a schema. Beyond
# this ``fit_levels`` and ``one_hot_long`` do the same without any bound.
WIDE_MAX_LEVELS = 10_000


def digest_bucket(key: str, buckets: int, salt: str) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of md5(salt|key): no digit of
    the key decides it, and any SQL engine can reproduce it."""
    head = F.substring(F.md5(F.concat(F.lit(f"{salt}|"), F.col(key).cast("string"))), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def sql_digest_bucket(key: str, buckets: int, salt: str) -> str:
    """SQL twin of ``digest_bucket``."""
    return (f"cast(cast('0x' || substr(md5(concat('{salt}|', cast({key} AS varchar))), 1, 8) AS bigint)"
            f" % {buckets} AS integer)")


def split_bucket(key: str, seed: int = 0, method: str = "hash") -> Column:
    """Bucket 0..99 that depends only on the row key, so the split is the same
    however the data is partitioned. ``hash`` uses xxhash64; ``digest`` is
    md5, which any SQL engine can reproduce."""
    if method == "hash":
        return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100))
    return digest_bucket(key, 100, f"split{seed}")


def train_test_split(df: DataFrame, key: str, train_pct: int = 70, seed: int = 0,
                     method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """70/30 split by key: a narrow filter on each side, no shuffle."""
    b = split_bucket(key, seed, method)
    return df.filter(b < train_pct), df.filter(b >= train_pct)


def tag_split(df: DataFrame, key: str, train_pct: int = 70, seed: int = 0,
              method: str = "hash", out: str = "conjunto") -> DataFrame:
    b = split_bucket(key, seed, method)
    return df.withColumn(out, F.when(b < train_pct, F.lit("train")).otherwise(F.lit("test")))


def fit_modes(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row frame with the most frequent non-null value of each column
    (ties -> lowest value; null for a column without values). Values are counted
    map-side and the best count is a partial aggregate too, so no task holds all
    distinct values of a column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("v"))
                                for c in cols]))
    counted = (train.select(pairs.alias("p")).select("p.*").filter(F.col("v").isNotNull())
               .groupBy("variable", "v").agg((-F.count(F.lit(1))).alias("minus")))
    best = counted.agg(*[F.min(F.when(F.col("variable") == c, F.struct("minus", "v"))).alias(c) for c in cols])
    types = dict(train.dtypes)
    return best.select(*[F.col(c)["v"].cast(types[c]).alias(c) for c in cols])


def fill_with(df: DataFrame, fills: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace nulls by the values of a one-row frame, read as scalar
    subqueries (evaluated once, no join)."""
    return df.select(*[F.coalesce(F.col(c), fills.select(c).scalar()).alias(c) if c in cols
                       else F.col(c) for c in df.columns])


def impute_mode(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Fill nulls in both sets with the mode learned on the training set."""
    modes = fit_modes(train, cols)
    return fill_with(train, modes, cols), fill_with(test, modes, cols)


def vocabulary(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null levels of each column — the metadata of a
    fitted encoder — from one distinct job over all columns (partial dedup
    map-side), bounded by WIDE_MAX_LEVELS."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"),
                                         F.col(c).cast("string").alias("v")) for c in cols]))
    levels = df.select(pairs.alias("p")).select("p.*").filter(F.col("v").isNotNull()).distinct()
    # one job; at most WIDE_MAX_LEVELS + 1 rows ever reach the driver
    rows = levels.limit(WIDE_MAX_LEVELS + 1).collect()
    if len(rows) > WIDE_MAX_LEVELS:
        raise ValueError(f"more than {WIDE_MAX_LEVELS} levels for a wide table; use one_hot_long")
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        out[r.variable].append(r.v)
    return {c: sorted(v) for c, v in out.items()}


def fit_levels(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The fitted encoder as a table (variable, level): the distinct non-null
    levels of each column, however many there are."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"),
                                         F.col(c).cast("string").alias("level")) for c in cols]))
    return train.select(pairs.alias("p")).select("p.*").filter(F.col("level").isNotNull()).distinct()


def one_hot_long(df: DataFrame, levels: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The ones of a one-hot encoding as rows (keep..., variable, level); levels
    unseen in training and nulls give no row. An equi-join with the level table,
    which the planner broadcasts only if it measures it as small."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"),
                                         F.col(c).cast("string").alias("level")) for c in cols]))
    return df.select(*keep, pairs.alias("p")).select(*keep, "p.*").join(levels, ["variable", "level"]).select(
        *keep, "variable", "level")


def dummy_name(col: str, level: str) -> str:
    return f"{col}_{level}"


def fit_one_hot(train: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    return vocabulary(train, cols)


def one_hot(df: DataFrame, vocab: dict[str, list[str]], keep: Sequence[str] = ()) -> DataFrame:
    """Wide 0/1 columns for the fitted levels; a level unseen in training gets
    zeros in every column of its variable (and can be counted, see
    ``unseen_levels``). Null -> zeros."""
    dummies = [F.when(F.col(c) == lv, 1).otherwise(0).cast("int").alias(dummy_name(c, lv))
               for c, levels in vocab.items() for lv in levels]
    return df.select(*keep, *dummies)


def unseen_levels(df: DataFrame, levels: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, level, n): the levels that the fitted encoder does not have and
    so drops, with their rows. Levels are counted map-side before the anti-join;
    ``levels`` is as ``fit_levels`` returns it."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"),
                                         F.col(c).cast("string").alias("level")) for c in cols]))
    counted = (df.select(pairs.alias("p")).select("p.*").filter(F.col("level").isNotNull())
               .groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n")))
    return counted.join(levels, ["variable", "level"], "left_anti")


def align_features(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` onto the training column list: missing dummies become 0,
    extra dummies (levels unseen in training) are dropped."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(f"`{c}`") if c in have else F.lit(0).alias(c) for c in columns])


def one_hot_inverse(df: DataFrame, vocab: dict[str, list[str]], keep: Sequence[str] = ()) -> DataFrame:
    """Back from dummies to one text column per fitted variable: the level whose
    dummy is largest (first in the vocabulary on ties), null if all are 0.
    Columns are found by the fitted names, so one variable's name may begin
    with another's."""
    out = [F.col(k) for k in keep]
    for var, levels in vocab.items():
        dummy = {lv: F.col(f"`{dummy_name(var, lv)}`") for lv in levels}
        most = F.greatest(F.lit(0), F.lit(0), *dummy.values())
        expr = F.lit(None).cast("string")
        for lv in reversed(levels):
            expr = F.when((dummy[lv] == most) & (most > 0), F.lit(lv)).otherwise(expr)
        out.append(expr.alias(var))
    return df.select(*out)
