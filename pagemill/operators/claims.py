"""Who owns which figure: claims, orphans, slots, identical assets, conservation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _owner(figures: DataFrame, heads: DataFrame, group: str, pos: str) -> DataFrame:
    """Figures with the ``block`` of the last head at or before them, or null; the ordered union of both, per group."""
    block = heads.schema["block"].dataType
    both = figures.withColumns({"block": F.lit(None).cast(block), "_f": F.lit(1)}).unionByName(heads.select(group, pos, "block").withColumn("_f", F.lit(0)), allowMissingColumns=True)
    w = W.partitionBy(group).orderBy(pos, "_f").rowsBetween(W.unboundedPreceding, 0)
    return both.withColumn("block", F.last("block", ignorenulls=True).over(w)).where("_f = 1").drop("_f")


def claimed(figures: DataFrame, heads: DataFrame, group: str, pos: str) -> DataFrame:
    return _owner(figures, heads, group, pos).where("block IS NOT NULL")


def orphans(figures: DataFrame, heads: DataFrame, group: str, pos: str, key_zone: DataFrame | None = None) -> DataFrame:
    """Figures that no block owns, with the reason; ``key_zone`` (group, lo, hi) is the answer key's half-open range."""
    free = _owner(figures, heads, group, pos).where("block IS NULL").drop("block")
    if key_zone is None:
        return free.withColumn("reason", F.lit("image_outside_blocks"))
    inside = F.coalesce((F.col(pos) >= F.col("lo")) & (F.col(pos) < F.col("hi")), F.lit(False))
    return free.join(key_zone, group, "left").withColumn("reason", F.when(inside, "image_in_answer_key_zone").otherwise("image_outside_blocks")).drop("lo", "hi")


def owners(figures: DataFrame, heads: DataFrame, group: str, pos: str) -> DataFrame:
    """``figures`` with ``zone`` (Q, SOL or null), ``q_no`` and, where nothing owns one, ``reason``.

    ``heads`` (group, pos, zone, q_no) are question headers, the answer key's line (KEY) and solution
    headers: a block runs from its header, included, to the next head. Question blocks end at the key,
    so they never meet solution blocks.
    """
    out = _owner(figures, heads.select(group, pos, F.struct("zone", "q_no").alias("block")), group, pos)
    zone = F.col("block.zone")
    owned = zone.isin("Q", "SOL")
    return out.withColumns({
        "zone": F.when(owned, zone), "q_no": F.when(owned, F.col("block.q_no")),
        "reason": F.when(zone == "KEY", "image_in_answer_key_zone").when(zone.isNull(), "image_outside_blocks"),
    }).drop("block")


def option_owners(figures: DataFrame, markers: DataFrame, group: str, pos: str) -> DataFrame:
    """``figures`` of owned blocks with ``kind`` (Q, SOL, OPT) and ``letter``: in a question the last option marker at or before a figure owns it.

    ``markers`` are ``group, q_no, pos, letter``.
    """
    q = figures.where("zone = 'Q'")
    keyed = lambda df: df.withColumn("_k", F.struct(group, "q_no"))
    at = _owner(keyed(q), keyed(markers).select("_k", pos, F.upper("letter").alias("block")), "_k", pos).drop("_k")
    at = at.withColumns({"letter": F.col("block"), "kind": F.when(F.col("block").isNotNull(), "OPT").otherwise("Q")}).drop("block")
    rest = figures.where("zone = 'SOL'").withColumns({"letter": F.lit(None).cast("string"), "kind": F.lit("SOL")})
    return at.unionByName(rest)


def manifest(claims: DataFrame, q_id: Column) -> DataFrame:
    """``q_id, type, option_letter, file, source_pages, extraction_page, table_id``, one row for each claim."""
    kind = F.when(F.col("kind") == "Q", "QUESTION").when(F.col("kind") == "SOL", "SOLUTION").otherwise("OPTION")
    letter = F.when(F.col("kind") == "OPT", F.col("letter"))
    return claims.select(q_id.alias("q_id"), kind.alias("type"), letter.alias("option_letter"), "file", F.array("page").alias("source_pages"), F.col("page").alias("extraction_page"), "table_id")


def files_by_slot(claims: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """``keys, kind, letter, files``: the files of each slot in the order of claims."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(seq, "file"))), lambda x: x["file"])
    return claims.groupBy(*keys, "kind", "letter").agg(listed.alias("files"))


def first_pages(claims: DataFrame, seq: str) -> DataFrame:
    """``file, page``: where each file was claimed first."""
    return claims.groupBy("file").agg(F.min_by("page", seq).alias("page"))


def ownership(claims: DataFrame, owner: Column) -> DataFrame:
    """The ownership ledger's row of each claim: slot, and in words why the figure is the owner's."""
    slot = F.when(F.col("kind") == "OPT", F.concat(F.lit("option_"), F.lower("letter"))).when(F.col("kind") == "Q", "question").otherwise("solution")
    why = (
        F.when((F.col("xref") == -1) & F.col("table_id").isNotNull(), "clip render of printed table region")
        .when(F.col("merged") > 0, F.concat(F.lit("clip render merging "), F.col("merged"), F.lit(" adjacent placements of one figure")))
        .otherwise(F.concat(F.lit("xref "), F.col("xref"), F.lit(" bbox center inside block interval")))
    )
    fixed = {"method": "textlayer_geometry", "confidence": "high", "outcome": "claimed"}
    return claims.select(owner.alias("owner"), "file", "page", slot.alias("slot"), why.alias("evidence"), *[F.lit(v).alias(k) for k, v in fixed.items()])


def orphan_rows(figures: DataFrame, group: str) -> DataFrame:
    """The ledger's row of each figure that nothing owns."""
    return figures.where("zone IS NULL").select(group, F.array("page").alias("source_pages"), F.lit("IMAGE_CLAIM").alias("pass"), "reason", F.lit("").alias("fragment"))


def renders(regions: DataFrame, structured: DataFrame, box: list[str], order: list[str]) -> DataFrame:
    """Table regions to render: those whose table has no text of its own, each box once, by ``order``."""
    open_ = regions.join(structured.select("table_id").distinct(), "table_id", "left_anti")
    return open_.groupBy(*box).agg(F.min_by(F.struct(*[c for c in open_.columns if c not in box]), F.struct(*order)).alias("_r")).select(*box, "_r.*")


def slot_names(figures: DataFrame, group: str, kind: str, order: list[str]) -> DataFrame:
    """``figures`` with ``name``: a running number for each group and kind; figures that are dropped later keep theirs."""
    n = F.row_number().over(W.partitionBy(group, kind).orderBy(*order))
    return figures.withColumn("name", F.format_string("%d_%s_%02d", F.col(group), F.col(kind), n))


def deduplicated(named: DataFrame, digest: str, seq: str, name: str) -> DataFrame:
    """``named`` with ``file``, the first name of equal bytes, and ``shared``. A grouped minimum joined back, so a common picture is not sorted."""
    first = named.groupBy(digest).agg(F.min(F.struct(seq, name)).alias("_m")).select(digest, F.col(f"_m.{name}").alias("file"))
    return named.join(first, digest).withColumn("shared", F.col(name) != F.col("file"))


def kept_size(images: DataFrame, n_bytes: str, width: str, height: str, least_bytes: int = 1500, least_side: int = 24) -> DataFrame:
    return images.where((F.col(n_bytes) >= least_bytes) & (F.least(width, height) >= least_side))


def conservation(figures: DataFrame, group: str, outcome: str) -> DataFrame:
    """Placements of each group by what became of them; ``ok`` if the parts add up."""
    n = lambda v: F.count_if(F.col(outcome) == v)
    out = figures.groupBy(group).agg(F.count("*").alias("placements"), n("claimed").alias("claimed"), n("orphan").alias("orphaned"), n("skipped").alias("skipped"), n("merged").alias("merged"))
    return out.withColumn("ok", F.col("placements") == F.col("claimed") + F.col("orphaned") + F.col("skipped") + F.col("merged"))


def referenced(manifest: DataFrame, assets: DataFrame, key: str) -> DataFrame:
    """Assets that a manifest row names."""
    return assets.join(manifest.select(key), key, "left_semi")
