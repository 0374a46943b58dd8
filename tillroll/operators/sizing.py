"""Size checks that guard broadcasts and key assumptions.

A side is broadcast only after a check proves it holds at most ``max_rows``
rows **and** ``max_bytes`` bytes (8 per value, strings by their length). The
checks for all candidate sides of a plan run as **one** Spark job: each side
contributes at most ``max_rows + 1`` rows (a per-partition limit, so a huge
table stops early). Beyond a bound a join is left to the planner (sort-merge,
turned into a broadcast by AQE at run time when the shuffled side proves
small, and split by AQE's skew-join handling when one key is hot).

Dimension keys are checked the same way, in one job for all dimensions: a
``groupBy`` per dimension on the key as it is, with map-side partial counts,
then one row per dimension with its exact row count, bytes and largest count
of one key. A profile is kept for the version of the table it was taken from.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.errors import DuplicateKeyError

DEFAULT_BROADCAST_ROWS = 200_000
CONF_BROADCAST_ROWS = "tillroll.broadcast.maxRows"
DEFAULT_BROADCAST_BYTES = 32 << 20
CONF_BROADCAST_BYTES = "tillroll.broadcast.maxBytes"


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(CONF_BROADCAST_ROWS, str(DEFAULT_BROADCAST_ROWS)))


def broadcast_bytes(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(CONF_BROADCAST_BYTES, str(DEFAULT_BROADCAST_BYTES)))


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 8 for each value, and the length of each string."""
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema.fields
             if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return reduce(lambda a, b: a + b, texts, F.lit(8 * len(df.schema.fields))).cast("bigint")


def bounded_sizes(frames: list[DataFrame], cap: int) -> list[tuple[int, int]]:
    """(rows, bytes) of each frame, of its first ``cap + 1`` rows at most, in one job."""
    if not frames:
        return []
    tagged = [f.select(F.lit(i).alias("i"), row_bytes(f).alias("b")).limit(cap + 1) for i, f in enumerate(frames)]
    sizes = (reduce(DataFrame.unionAll, tagged)
             .groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).collect())
    got = {r["i"]: (r["n"], r["b"]) for r in sizes}
    return [got.get(i, (0, 0)) for i in range(len(frames))]


def bounded_counts(frames: list[DataFrame], cap: int) -> list[int]:
    """Row count of each frame, capped at ``cap + 1``, in one job."""
    return [n for n, _ in bounded_sizes(frames, cap)]


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has no more than ``max_rows`` rows (bounded scan)."""
    return bounded_counts([df], max_rows)[0] <= max_rows


def broadcast_small(frames: list[DataFrame], max_rows: int | None = None) -> list[DataFrame]:
    """Broadcast hint for each frame proven to be within both bounds (one
    job for all of them); the others are returned as they are."""
    if not frames:
        return []
    bound = broadcast_limit(frames[0]) if max_rows is None else max_rows
    most = broadcast_bytes(frames[0])
    return [F.broadcast(f) if n <= bound and b <= most else f for f, (n, b) in zip(frames, bounded_sizes(frames, bound))]


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Broadcast hint only for a side whose size is proven bounded."""
    return broadcast_small([df], max_rows)[0]


class Profile(tuple):
    """(rows, largest count of one non-NULL key, one such key as text, bytes)
    of a table, and in ``keys`` a hash of the set of its keys."""

    keys: int

    def __new__(cls, values: tuple, keys: int) -> Profile:
        self = super().__new__(cls, values)
        self.keys = keys
        return self


def key_profile(tables: dict[str, tuple[DataFrame, str]]) -> dict[str, Profile]:
    """A :class:`Profile` of each named ``(frame, key)``, all in one job."""
    parts = []
    for name, (df, key) in tables.items():
        per_key = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("c"), F.sum(row_bytes(df)).alias("b"))
        many = F.when(F.col("k").isNotNull(), F.col("c"))
        parts.append(per_key.agg(F.lit(name).alias("dim"), F.sum("c").alias("rows"), F.max(many).alias("max_c"),
                                 F.max(F.when(many > 1, F.col("k"))).cast("string").alias("key"), F.sum("b").alias("bytes"),
                                 F.bit_xor(F.xxhash64("k", F.lit(name))).alias("keys")))
    got = {r["dim"]: Profile((int(r["rows"] or 0), int(r["max_c"] or 0), r["key"], int(r["bytes"] or 0)), int(r["keys"] or 0))
           for r in reduce(DataFrame.unionAll, parts).collect()}
    return {name: got.get(name, Profile((0, 0, None, 0), 0)) for name in tables}


def table_version(df: DataFrame) -> str | None:
    """What a frame reads: its plan and the names, times and sizes of its
    files; None for a frame that reads no file (nothing tells a change)."""
    names = df.inputFiles()
    if not names:
        return None
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    seen = []
    for folder in sorted({n.rsplit("/", 1)[0] for n in names}):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        seen += [(s.getPath().toString(), s.getModificationTime(), s.getLen()) for s in path.getFileSystem(conf).listStatus(path)]
    text = repr((spark.sparkContext.applicationId, df.semanticHash(), sorted(names), sorted(seen)))
    return hashlib.sha256(text.encode()).hexdigest()


# Profiles of the table versions seen, newest last.
_PROFILES: OrderedDict[tuple, tuple] = OrderedDict()
KEPT_PROFILES = 256


def load_profile(tables: dict[str, tuple[DataFrame, str]]) -> dict[str, tuple]:
    """:func:`key_profile`, once per table version: a table already profiled
    is neither read nor shuffled again; a changed one is profiled anew."""
    versions = {name: table_version(df) for name, (df, _) in tables.items()}
    keys = {name: (versions[name], name, key) for name, (_, key) in tables.items()}
    missing = {name: t for name, t in tables.items() if versions[name] is None or keys[name] not in _PROFILES}
    new = key_profile(missing) if missing else {}
    out = {name: new[name] if name in new else _PROFILES[keys[name]] for name in tables}
    for name, profile in new.items():
        if versions[name] is not None:
            _PROFILES[keys[name]] = profile
    while len(_PROFILES) > KEPT_PROFILES:
        _PROFILES.popitem(last=False)
    return out


def small_sides(profile: dict[str, tuple], like: DataFrame) -> dict[str, bool]:
    """Which profiled tables are within both broadcast bounds."""
    rows, most = broadcast_limit(like), broadcast_bytes(like)
    return {name: p[0] <= rows and p[3] <= most for name, p in profile.items()}


def raise_on_duplicates(profile: dict[str, tuple], keys: dict[str, str]) -> None:
    """A duplicate key would fan out every matching fact row and inflate the
    mart totals, so it is refused before any join."""
    for name, (_, max_c, key, *_) in profile.items():
        if max_c > 1:
            raise DuplicateKeyError(f"{name}: key {keys[name]}={key} occurs {max_c} times")


def assert_unique(df: DataFrame, key: str, table: str = "dimension") -> None:
    """Raise :class:`DuplicateKeyError` if a dimension has two rows for one key."""
    raise_on_duplicates(key_profile({table: (df, key)}), {table: key})
