"""Binary incidence as blocks of bits.

A feature gets a dense number; an entity's features are then blocks of 32,768 bits
(Spark's bitmap functions), one row per entity and block that has any. Set sizes are
bit counts, a union is the OR of two blocks, and a lookup reads one bit. Against the
long table, rows shrink by the fill of a block; a block takes 4 kB whatever its fill, so the form pays where
entities have some hundred features per 32,768 (the long form of :mod:`quarry.operators.cluster` suits
sparser data).

Null entities and features take no part; repeated pairs set the same bit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ids import contiguous_id
from quarry.session import saved


@dataclass
class BitIncidence:
    """``blocks(entity, block, bits, n)`` and ``numbers(feature, number)``, number from 1."""
    blocks: DataFrame
    numbers: DataFrame
    entity_col: str
    feature_col: str


def bit_incidence(incidence: DataFrame, entity_col: str = "entity", feature_col: str = "feature") -> BitIncidence:
    """Blocks of an incidence. The bits are ORed map-side first, so an entity with a large part of all rows costs one
    block of each number range per task."""
    pairs = incidence.select(entity_col, feature_col).dropna()
    features = contiguous_id(pairs.select(feature_col).distinct(), [feature_col], "number")
    numbers = saved(features.withColumn("number", F.col("number") + 1), "bit-numbers")
    blocks = pairs.join(numbers, feature_col).groupBy(entity_col, F.bitmap_bucket_number("number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    blocks = saved(blocks.withColumn("n", F.bitmap_count("bits")), "bit-blocks")
    return BitIncidence(blocks, numbers, entity_col, feature_col)


def bit_sizes(bits: BitIncidence) -> DataFrame:
    """(entity, n features)."""
    return bits.blocks.groupBy(bits.entity_col).agg(F.sum("n").cast("long").alias("n"))


def pair_distance_bits(pairs: DataFrame, bits: BitIncidence, left: str = "left", right: str = "right") -> DataFrame:
    """Squared distance of each requested pair: ``2·|A ∪ B| − |A| − |B|``, the union by ORing blocks.

    A pair and its mirror image are worked off once; entities without features have empty sets. Each pair
    meets only the blocks of its two entities, with AQE splitting an entity that is in many pairs.
    """
    a, b = F.least(left, right), F.greatest(left, right)
    asked = saved(pairs.select(left, right).distinct(), "bit-pairs")
    once = asked.where(F.col(left) != F.col(right)).select(a.alias("_a"), b.alias("_b")).distinct()
    blocks = bits.blocks.withColumnRenamed(bits.entity_col, "_e")
    sides = [once.withColumn("_e", F.col(c)).join(blocks, "_e").select("_a", "_b", "block", "bits", "n") for c in ("_a", "_b")]
    # the two blocks of a pair meet in one group; a block that only one side has counts by itself
    met = sides[0].union(sides[1]).groupBy("_a", "_b", "block").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("both"), F.sum("n").alias("n"))
    found = met.groupBy("_a", "_b").agg((2 * F.sum("both") - F.sum("n")).cast("long").alias("d2"))
    return asked.withColumn("_a", a).withColumn("_b", b).join(found, ["_a", "_b"], "left").select(
        left, right, F.coalesce("d2", F.lit(0).cast("long")).alias("d2"))


def membership_bits(probes: DataFrame, bits: BitIncidence, out: str = "present") -> DataFrame:
    """Every probe row with ``out``: whether the bit of (entity, feature) is set; unknown ones give false."""
    e, f = bits.entity_col, bits.feature_col
    numbered = probes.join(bits.numbers, f, "left").withColumn("block", F.bitmap_bucket_number("number"))
    met = numbered.join(bits.blocks.select(e, "block", "bits"), [e, "block"], "left")
    place = F.bitmap_bit_position("number")
    byte = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (place % 8).cast("int") + 1)) != 0
    return met.withColumn(out, F.coalesce(bit, F.lit(False))).select(*probes.columns, out)
