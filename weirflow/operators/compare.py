"""Field-by-field comparison of two tables of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.session import materialize

# Ranges of keys whose digests are compared before any record is.
RANGES = 4096


def as_records(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns plus all other columns as a name -> text map, null fields included."""
    names = [c for c in df.columns if c not in keys]
    entries = []
    for name in names:
        entries += [F.lit(name), F.col(name).cast("string")]
    return df.select(*keys, F.create_map(*entries).alias("record"))


def compare_records(
    left: DataFrame, right: DataFrame, keys: Sequence[str], ranges: int = RANGES
) -> DataFrame:
    """One row per difference: key, ``field``, ``status``, both values, ``copies``.

    ``status`` is ``missing`` (only left), ``extra`` (only right) or
    ``different``. Both inputs hold ``record`` maps. Digests of ranges of keys are
    compared first (``differing_ranges``), so of equal parts no record is shuffled. In
    the others equal records cancel out, copy by copy, in one aggregation that combines
    copies before the shuffle. What is left over is compared field by field inside the row where a key has at
    most one record per side. Where it has several, none is the counterpart of
    another, so each is reported whole, with its number of copies.
    """
    left, right = (_hashed(side, keys, ranges) for side in (left, right))
    differing = F.broadcast(differing_ranges(left, right))  # at most ``ranges`` rows
    left, right = (side.join(differing, "range", "left_semi") for side in (left, right))
    surplus = materialize(_surplus(left, right, keys), "differences")
    on_left, on_right = F.col("n") > 0, F.col("n") < 0
    per_key = surplus.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(on_left, F.col("n"))), F.lit(0)).alias("_ln"),
        F.coalesce(F.sum(F.when(on_right, -F.col("n"))), F.lit(0)).alias("_rn"),
        F.max(F.when(on_left, F.col("entries"))).alias("_l"),
        F.max(F.when(on_right, F.col("entries"))).alias("_r"),
    )
    several = (F.col("_ln") > 1) | (F.col("_rn") > 1)
    pairs = per_key.filter(~several)
    whole = surplus.join(per_key.filter(several).select(*keys), list(keys), "left_semi")
    return _field_differences(pairs, keys).unionByName(
        whole.select(*keys, "n", F.explode("entries").alias("e")).select(
            *keys,
            F.col("e.key").alias("field"),
            F.when(on_left, "missing").otherwise("extra").alias("status"),
            F.when(on_left, F.col("e.value")).alias("left_value"),
            F.when(on_right, F.col("e.value")).alias("right_value"),
            F.abs("n").alias("copies"),
        )
    )


def _hashed(records: DataFrame, keys: Sequence[str], ranges: int) -> DataFrame:
    """``keys, entries`` (the record in order of its names) and the ``range`` of the key's hash."""
    entries = F.array_sort(F.map_entries("record")).alias("entries")
    in_range = F.pmod(F.xxhash64(*keys), F.lit(ranges)).alias("range")
    return records.select(*keys, entries, in_range)


def differing_ranges(left: DataFrame, right: DataFrame) -> DataFrame:
    """``range``: those whose records differ between the two sides.

    A range's digest is the number of its records and two sums of their hashes, so it
    depends on neither order nor partitions, and a record more or less changes it. Digests
    are combined in the map tasks; what is shuffled are at most ``ranges`` rows per task.
    """
    rows = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(-1)))
    data = [c for c in rows.columns if c not in ("range", "side")]

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), *data).cast("decimal(20,0)") * F.col("side"))

    sums = rows.groupBy("range").agg(F.sum("side").alias("n"), total(1).alias("a"), total(2).alias("b"))
    return sums.filter("n <> 0 OR a <> 0 OR b <> 0").select("range")


def _surplus(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Records one side has more copies of: ``n`` above 0 for left, below 0 for right."""
    both = left.select(*keys, "entries", F.lit(1).alias("side")).unionByName(
        right.select(*keys, "entries", F.lit(-1).alias("side"))
    )
    return both.groupBy(*keys, "entries").agg(F.sum("side").alias("n")).filter("n <> 0")


def _field_differences(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Differing fields of the left and right record of each key, either may be absent."""
    none = F.expr("map()").cast("map<string,string>")
    both = pairs.withColumns(
        {side: F.coalesce(F.map_from_entries(side), none) for side in ("_l", "_r")}
    )
    fields = F.array_union(F.map_keys("_l"), F.map_keys("_r"))

    def status(name):
        in_left = F.map_contains_key("_l", name)
        in_right = F.map_contains_key("_r", name)
        same = F.try_element_at("_l", name).eqNullSafe(F.try_element_at("_r", name))
        return F.when(~in_right, "missing").when(~in_left, "extra").when(~same, "different")

    found = F.transform(
        fields,
        lambda name: F.struct(
            name.alias("field"),
            status(name).alias("status"),
            F.try_element_at("_l", name).alias("left_value"),
            F.try_element_at("_r", name).alias("right_value"),
            F.lit(1).cast("bigint").alias("copies"),
        ),
    )
    differences = F.filter(found, lambda d: d["status"].isNotNull())
    return both.select(*keys, F.explode(differences).alias("d")).select(*keys, "d.*")


def field_counts(records: DataFrame) -> DataFrame:
    """Number of records and of fields over all records."""
    return records.agg(
        F.count("*").alias("records"),
        F.coalesce(F.sum(F.size(F.map_keys("record"))), F.lit(0)).alias("fields"),
    )
