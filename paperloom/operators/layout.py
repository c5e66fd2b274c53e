"""Page layout: suppression, merging, fusion, template matching and reading order.

Regions are rows with doc_id, pos (the list order that breaks ties), region_id,
region_type, a box struct and confidence. Greedy steps are folds over one page's sorted
array; every other step is a join on doc_id or a window within a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G

PROTECTED = ("seal", "signature", "figure", "table")
_REGION = "struct<pos:int,region_id:string,region_type:string,box:struct<x1:int,y1:int,x2:int,y2:int>,confidence:double>"


def _page(regions: DataFrame, *extra: str) -> Column:
    return F.collect_list(F.struct("pos", "region_id", "region_type", F.col("box").cast("struct<x1:int,y1:int,x2:int,y2:int>").alias("box"), F.col("confidence").cast("double").alias("confidence"), *extra))


def scored(detections: DataFrame, least: float = 0.3) -> DataFrame:
    return detections.where(F.col("confidence") >= least)


def large_enough(regions: DataFrame, page_area: Column, share: float = 0.001) -> DataFrame:
    return regions.where(G.area(F.col("box")) >= (page_area * share).cast("int"))


def without_micro(regions: DataFrame, least: int = 6) -> DataFrame:
    return regions.where((G.width(F.col("box")) >= least) & (G.height(F.col("box")) >= least))


def suppressed_array(page: Column, limit: float, seal_limit: float | None = None) -> Column:
    """The regions of a page that greedy suppression keeps: by confidence, dropped if over the limit with one kept before."""
    ordered = F.array_sort(page, lambda a, b: F.when(a["confidence"] > b["confidence"], -1).when(a["confidence"] < b["confidence"], 1).otherwise(a["pos"] - b["pos"]))

    def clashes(k: Column, r: Column) -> Column:
        most = F.lit(limit) if seal_limit is None else F.when((k["region_type"] == "seal") | (r["region_type"] == "seal"), seal_limit).otherwise(limit)
        return G.iou(r["box"], k["box"]) > most

    return F.aggregate(ordered, F.array().cast(f"array<{_REGION}>"), lambda kept, r: F.when(F.exists(kept, lambda k: clashes(k, r)), kept).otherwise(F.array_append(kept, r)))


def suppressed(regions: DataFrame, limit: float = 0.3, seal_limit: float | None = None) -> DataFrame:
    """Rows that remain, with rank: their place by confidence."""
    pages = regions.groupBy("doc_id").agg(_page(regions).alias("page"))
    return pages.select("doc_id", F.posexplode(suppressed_array(F.col("page"), limit, seal_limit)).alias("rank", "r")).select("doc_id", "rank", "r.*")


def refined(regions: DataFrame, limit: float = 0.7, seal_limit: float = 0.5) -> DataFrame:
    return suppressed(regions, limit, seal_limit)


def merged_array(texts: Column, across: int = 20, down: int = 15) -> Column:
    """Text blocks from top to bottom, each joined to the block before it, as that has become, if near below it."""
    ordered = F.array_sort(texts, lambda a, b: F.coalesce(*[F.nullif(a["box"][c] - b["box"][c], F.lit(0)) for c in ("y1", "x1")], a["pos"] - b["pos"]))
    member = F.array().cast("array<string>")
    state = f"array<struct<r:{_REGION},members:array<string>>>"

    def step(done: Column, r: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        p, c = last["r"]["box"], r["box"]
        near = (F.abs(G.center(c)["x"] - G.center(p)["x"]) <= across) & (c["y1"] - p["y2"]).between(0, down)
        grown = F.struct(
            F.struct(
                last["r"]["pos"].alias("pos"), last["r"]["region_id"].alias("region_id"), last["r"]["region_type"].alias("region_type"),
                G.box(F.least(p["x1"], c["x1"]), p["y1"], F.greatest(p["x2"], c["x2"]), c["y2"]).alias("box"), F.greatest(last["r"]["confidence"], r["confidence"]).alias("confidence"),
            ).alias("r"),
            F.array_append(last["members"], r["region_id"]).alias("members"),
        )
        alone = F.struct(r.alias("r"), member.alias("members"))
        return F.when(F.coalesce(near, F.lit(False)), F.array_append(F.slice(done, 1, F.size(done) - 1), grown)).otherwise(F.array_append(done, alone)).cast(state)

    return F.aggregate(ordered, F.array().cast(state), step)


def merged_texts(regions: DataFrame, across: int = 20, down: int = 15) -> DataFrame:
    """Rows after merging; members are the ids that a row has taken in."""
    texts = regions.where("region_type = 'text'").groupBy("doc_id").agg(_page(regions).alias("page"))
    rows = texts.select("doc_id", F.explode(merged_array(F.col("page"), across, down)).alias("m")).select("doc_id", "m.r.*", "m.members")
    others = regions.where("region_type <> 'text'").select("doc_id", "pos", "region_id", "region_type", "box", "confidence", F.array().cast("array<string>").alias("members"))
    return rows.unionByName(others)


def columns_of(regions: DataFrame, page_width: Column, gap: float = 0.03) -> DataFrame:
    """Body regions with the column they are in.

    In order of their middles, a region opens a column if its middle lies over the gap to
    the right of all before it. That is the same as comparing with the current column only,
    since a new column's right edge passes all earlier ones.
    """
    middle = G.center(F.col("box"))["x"]
    order = Window.partitionBy("doc_id").orderBy(middle, "pos")
    right = F.max(F.col("box")["x2"]).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((middle - right > page_width * gap).cast("int"), F.lit(0))
    return regions.withColumn("__opens", opens).withColumn("column", F.sum("__opens").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("__opens")


def reading_order(regions: DataFrame, page_width: Column, gap: float = 0.03) -> DataFrame:
    """regions with order_idx from 0: headers from the top, body by column, then footers."""
    kind = F.when(F.col("region_type") == "header", 0).when(F.col("region_type") == "footer", 2).otherwise(1)
    body = columns_of(regions.where(~F.col("region_type").isin("header", "footer")), page_width, gap)
    ends = regions.where(F.col("region_type").isin("header", "footer")).withColumn("column", F.lit(0))
    both = body.unionByName(ends).withColumn("__kind", kind)
    inside = F.when(F.col("__kind") == 1, F.col("box")["x1"]).otherwise(0)
    order = Window.partitionBy("doc_id").orderBy("__kind", "column", F.col("box")["y1"], inside, "pos")
    return both.withColumn("order_idx", F.row_number().over(order) - 1).drop("__kind")


def order_after_merge(order: DataFrame, kept: DataFrame, taken_in: DataFrame) -> DataFrame:
    """(doc_id, region_id, order_idx) of the kept regions.

    order(doc_id, region_id, order_idx) is the order before; what taken_in(doc_id,
    region_id, into) names stands for its target, at its first place; kept regions that the
    order doesn't name follow by their own place.
    """
    led = order.join(taken_in, ["doc_id", "region_id"], "left").select("doc_id", F.coalesce("into", "region_id").alias("region_id"), "order_idx")
    first = led.groupBy("doc_id", "region_id").agg(F.min("order_idx").alias("at"))
    placed = kept.select("doc_id", "region_id", "pos").join(first, ["doc_id", "region_id"], "left")
    turn = Window.partitionBy("doc_id").orderBy(F.col("at").isNull(), "at", "pos")
    return placed.select("doc_id", "region_id", (F.row_number().over(turn) - 1).alias("order_idx"))


def model_order(regions: DataFrame) -> DataFrame:
    """The model's order closed up; regions without one follow by place."""
    turn = Window.partitionBy("doc_id").orderBy(F.col("model_idx").isNull(), "model_idx", "pos")
    return regions.withColumn("order_idx", F.row_number().over(turn) - 1)


def fusion_order(regions: DataFrame) -> DataFrame:
    """Ordered structural regions, then others, then texts of the second model from the top."""
    second = F.col("source") == "plus_l"
    group = F.when(second, 2).when(F.col("model_idx").isNull(), 1).otherwise(0)
    keys = [group, F.when(second, 0).otherwise(F.coalesce("model_idx", F.lit(0))), F.when(second, F.col("box")["y1"]).otherwise(0), F.when(second, F.col("box")["x1"]).otherwise(0), F.col("pos")]
    return regions.withColumn("order_idx", F.row_number().over(Window.partitionBy("doc_id").orderBy(*keys)) - 1)


def renumbered(regions: DataFrame, order: str = "pos") -> DataFrame:
    return regions.withColumn("region_id", F.format_string("r_%04d", F.row_number().over(Window.partitionBy("doc_id").orderBy(order))))


def uncovered(texts: DataFrame, primary: DataFrame, share: float = 0.5) -> DataFrame:
    """Secondary texts of which no primary box of the same page covers share or more."""
    p = primary.select(F.col("doc_id").alias("__doc"), F.col("box").alias("__box"))
    return texts.join(p, (F.col("doc_id") == F.col("__doc")) & (G.covered(F.col("box"), F.col("__box")) >= share), "left_anti")


def fused(primary: DataFrame, secondary: DataFrame, share: float = 0.5) -> DataFrame:
    """All primary regions and the secondary texts that they don't cover."""
    texts = uncovered(secondary.where("region_type = 'text'"), primary, share)
    return primary.withColumn("source", F.lit("v3")).unionByName(texts.withColumn("source", F.lit("plus_l")), allowMissingColumns=True)


def uses_fusion(dpi: Column, below: int = 150) -> Column:
    return dpi < below


def unlike_fixed(regions: DataFrame, fixed: DataFrame, limit: float = 0.5) -> DataFrame:
    """Regions but for those without a field that lie on a fixed text."""
    f = fixed.where("box is not null").select(F.col("doc_id").alias("__doc"), F.col("box").alias("__box"))
    hit = (F.col("doc_id") == F.col("__doc")) & F.col("field_key").isNull() & (G.iou(F.col("box"), F.col("__box")) > limit)
    return regions.join(f, hit, "left_anti")


def template_matches(regions: DataFrame, template: DataFrame, inside: float = 0.7, contains: float = 0.9) -> DataFrame:
    """(doc_id, pos, field_ord): each detected box with the first template field that takes it.

    A field takes a box that lies mostly in it, unless the box is a container of the field
    or protected. The field takes all such boxes, so that the first field in order that may
    take a box does.
    """
    t = template.select(F.col("doc_id").alias("__doc"), F.col("ord").alias("field_ord"), F.col("box").alias("__box"))
    free = regions.where(~F.col("region_type").isin(*PROTECTED))
    fits = (F.col("doc_id") == F.col("__doc")) & (G.covered(F.col("box"), F.col("__box")) > inside) & (G.covered(F.col("__box"), F.col("box")) <= contains)
    return free.join(t, fits).groupBy("doc_id", "pos").agg(F.min("field_ord").alias("field_ord"))


def templated(regions: DataFrame, template: DataFrame, small: float = 0.6) -> DataFrame:
    """Template regions, then the boxes that none took.

    A field that took one box not much smaller than itself keeps that box and its id; any
    other has the template's box, confidence 0.99 and a number t_0001 and so on.
    """
    taken = template_matches(regions, template)
    boxes = taken.join(regions.select("doc_id", "pos", "region_id", "box", "confidence"), ["doc_id", "pos"])
    by_field = boxes.groupBy("doc_id", F.col("field_ord").alias("ord")).agg(F.count("*").alias("n"), F.min_by(F.struct("region_id", "box", "confidence"), "pos").alias("one"))
    t = template.join(by_field, ["doc_id", "ord"], "left")
    exact = F.coalesce((F.col("n") == 1) & (G.area(F.col("one.box")) >= small * G.area(F.col("box"))), F.lit(False))
    number = F.sum((~exact).cast("int")).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    fields = t.withColumns({"__exact": exact}).select(
        "doc_id", F.col("ord").alias("pos"), F.when(F.col("__exact"), F.col("one.region_id")).otherwise(F.format_string("t_%04d", number)).alias("region_id"), "region_type",
        F.when(F.col("__exact"), F.col("one.box")).otherwise(F.col("box")).alias("box"), F.when(F.col("__exact"), F.col("one.confidence")).otherwise(F.lit(0.99)).alias("confidence"),
        F.when(F.col("__exact"), "template_matched").otherwise("template").alias("source"), "field_key",
    )
    rest = regions.join(taken, ["doc_id", "pos"], "left_anti").select("doc_id", (F.col("pos") + 100_000).alias("pos"), "region_id", "region_type", "box", "confidence", F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("field_key"))
    return fields.unionByName(rest)


def template_version(versions: DataFrame, documents: DataFrame) -> DataFrame:
    """documents with the version of their form's template that has their identifier, else the first one."""
    v = versions.select("form_type", "version", F.col("form_identifier").alias("__id"), F.col("ord").alias("__ord"))
    joined = documents.join(v, "form_type", "left").groupBy("doc_id").agg(F.min_by("version", F.struct((F.col("__id") != F.col("form_identifier")) | F.col("form_identifier").isNull() | F.col("__id").isNull(), "__ord")).alias("version"))
    return documents.join(joined, "doc_id", "left")


def position_type(box: Column, page_height: Column, edge: float = 0.08) -> Column:
    """Header or footer by place, else text."""
    return F.when(box["y2"] <= page_height * edge, "header").when(box["y1"] >= page_height * (1 - edge), "footer").otherwise("text")
