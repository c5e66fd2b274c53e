"""The boundary to models: a provider answers tasks within mapInPandas, one partition at a time.

A provider is any object with run(task: dict) -> dict; it is made once for each task of the
cluster by a factory, so that clients are opened where they are used. A replay provider
answers from recorded responses, which a join attaches to the tasks instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as X
from ..functions.scoring import classified_confidence, clamped, token_confidence
from ..model import BUDGET_OF_CONTENT, CLASS_OF_TYPE, REGION_OF_CONTENT, least_confidence, looked_up, pixel_budget, skill

# The margin of a crop, as a part of its sides.
PADDING = {"text": 0.05, "header": 0.05, "footer": 0.05, "handwritten_field": 0.15, "seal": 0.10, "table": 0.05, "signature": 0.10}
DEFAULT_PADDING = 0.05
ANSWER = "doc_id string, region_id string, content string, logprobs array<double>, content_type string, confidence double, warning string"


class Provider(Protocol):
    def run(self, task: dict) -> dict: ...


def tasks(regions: DataFrame) -> DataFrame:
    """A task for each region that a skill reads, with its budget and padded crop; empty crops go."""
    ratio = looked_up(F.col("region_type"), PADDING, DEFAULT_PADDING)
    b = F.col("box")
    x, y = (F.greatest(F.lit(3), (side * ratio).cast("int")) for side in (G.width(b), G.height(b)))
    crop = G.box(F.greatest(b["x1"] - x, F.lit(0)), F.greatest(b["y1"] - y, F.lit(0)), F.least(b["x2"] + x, F.col("page_width")), F.least(b["y2"] + y, F.col("page_height")))
    out = regions.withColumns({"skill": skill(F.col("region_type")), "pixel_budget": pixel_budget(F.col("region_type")), "crop": crop})
    return out.where(F.col("skill").isNotNull() & (F.col("skill") != "S5") & (G.width(F.col("crop")) > 0) & (G.height(F.col("crop")) > 0))


def cell_tasks(cells: DataFrame) -> DataFrame:
    """Cells of tables as tasks, but for empty ones."""
    kind = F.col("content_type")
    full = cells.where(kind != "empty")
    return full.withColumns({"region_id": F.format_string("%s_r%dc%d", "region_id", "row", "col"), "region_type": looked_up(kind, REGION_OF_CONTENT, "text"), "pixel_budget": looked_up(kind, BUDGET_OF_CONTENT, 560)})


def answered(work: DataFrame, factory: Callable[[], Provider], by_budget: bool = True) -> DataFrame:
    """Answers to work(doc_id, region_id, ...); a failure is an answer of type error with confidence 0.

    Tasks of a budget go together, so that a server sees like prompts in a row; they are
    spread by document as well, as one budget may be that of most tasks.
    """
    columns = work.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = factory()
        for frame in frames:
            rows = []
            for task in frame[columns].to_dict("records"):
                base = {"doc_id": task["doc_id"], "region_id": task["region_id"], "content": None, "logprobs": None, "content_type": "text", "confidence": None, "warning": None}
                try:
                    rows.append(base | provider.run(task))
                except Exception as e:  # noqa: BLE001  a model's failure is a result
                    rows.append(base | {"content": "", "content_type": "error", "confidence": 0.0, "warning": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ANSWER.split(", ")])

    dealt = work.repartition("pixel_budget", "doc_id").sortWithinPartitions("pixel_budget") if by_budget and "pixel_budget" in columns else work
    return dealt.mapInPandas(run, ANSWER)


def replayed(work: DataFrame, responses: DataFrame, attempt: int = 0) -> DataFrame:
    """work with the recorded response of an attempt; a task without one is an error."""
    r = responses.where(F.col("attempt") == attempt).select("doc_id", "region_id", "content", "logprobs")
    out = work.join(r, ["doc_id", "region_id"], "left")
    return out.withColumn("content_type", F.when(F.col("content").isNull(), "error").otherwise("text"))


def scored_answers(answers: DataFrame, data_type: Column) -> DataFrame:
    """Answers with the confidence that their tokens give, unless they state one."""
    return answers.withColumn("confidence", F.coalesce("confidence", token_confidence(F.col("logprobs"), looked_up(data_type, CLASS_OF_TYPE, "text"))))


def classification(answers: DataFrame, forms: list[str]) -> DataFrame:
    """form_type, confidence and identifier of classification answers: from their JSON, else the first form, in order, that they name."""
    v = X.tolerant_json(F.col("content"))
    stated = F.lower(F.trim(F.try_variant_get(v, "$.form_type", "string")))
    named = F.coalesce(*[F.when(F.lower("content").contains(f), F.lit(f)) for f in forms])
    form = F.coalesce(F.when(stated.isin(*forms), stated), named, F.lit("unknown"))
    return answers.select("doc_id", form.alias("form_type"), F.round(classified_confidence(F.try_variant_get(v, "$.confidence", "double"), F.col("logprobs")), 4).alias("form_confidence"), F.nullif(F.trim(F.try_variant_get(v, "$.form_identifier", "string")), F.lit("")).alias("form_identifier"))


def seal_answer(content: Column) -> Column:
    v = X.tolerant_json(content)
    return F.struct(F.coalesce(F.try_variant_get(v, "$.text", "string"), content).alias("text"), clamped(F.coalesce(F.try_variant_get(v, "$.confidence", "double"), F.lit(0.0))).alias("confidence"))


def signature_answer(content: Column) -> Column:
    v = X.tolerant_json(content)
    return F.struct(F.coalesce(F.try_variant_get(v, "$.signature_present", "boolean"), F.lit(False)).alias("present"), clamped(F.coalesce(F.try_variant_get(v, "$.confidence", "double"), F.lit(0.0))).alias("confidence"))


def better_of(first: Column, second: Column) -> Column:
    """Of two answer structs the one with the greater confidence, the first if equal."""
    return F.when(F.coalesce(second["confidence"], F.lit(-1.0)) > first["confidence"], second).otherwise(first)


def field_logprobs(value: Column, logprobs: Column, is_scalar: Column) -> Column:
    """A scalar has as many of the answer's tokens as it has characters, at least one; anything else has all."""
    return F.when(is_scalar, F.slice(logprobs, F.lit(1), F.greatest(F.lit(1), F.length(value)))).otherwise(logprobs)


def table_cells(answers: DataFrame) -> DataFrame:
    """Cells of table answers; keys may be spelt in three ways."""
    v = X.tolerant_json(F.col("content"))
    cells = F.try_variant_get(v, "$.cells", "array<variant>")

    def pick(cell: Column, kind: str, *keys: str) -> Column:
        return F.coalesce(*[F.try_variant_get(cell, f"$.{k}", kind) for k in keys])

    one = answers.select("doc_id", "region_id", F.posexplode(cells).alias("pos", "c"))
    c = F.col("c")
    kind = F.lower(F.coalesce(pick(c, "string", "content_type", "type"), F.lit("printed")))
    return one.select("doc_id", "region_id", "pos", F.coalesce(pick(c, "int", "row", "row_index", "r"), F.lit(0)).alias("row"), F.coalesce(pick(c, "int", "col", "col_index", "c"), F.lit(0)).alias("col"), pick(c, "string", "role").alias("role"), kind.alias("content_type"), pick(c, "string", "text", "content").alias("text"))


def table_context(cells: DataFrame, results: DataFrame) -> DataFrame:
    """(doc_id, region_id, matrix): the cells' contents, row by row; the type in brackets where nothing was read."""
    r = results.select("doc_id", F.col("region_id").alias("__cell"), F.col("content").alias("__content"))
    named = cells.withColumn("__cell", F.format_string("%s_r%dc%d", "region_id", "row", "col")).join(r, ["doc_id", "__cell"], "left")
    text = F.coalesce("__content", "text", F.when(F.col("content_type") != "empty", F.format_string("(%s)", "content_type")), F.lit(""))
    rows = named.withColumn("t", text).groupBy("doc_id", "region_id", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "t"))), lambda x: x["t"]), " | ").alias("line"))
    return rows.groupBy("doc_id", "region_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "line"))), lambda x: x["line"]), "\n").alias("matrix"))


def skill_context(results: DataFrame, tables: DataFrame) -> DataFrame:
    """(doc_id, context): what the skills read, then the tables, for one prompt."""
    prefix = looked_up(F.col("skill_name"), {"S2": "TEXT", "S3": "HANDWRITTEN", "S4": "SEAL", "S6": "SIGNATURE"}, "TEXT")
    lines = results.select("doc_id", F.lit(0).alias("part"), "pos", F.format_string("[%s] %s (%s)", prefix, X.shortened(F.coalesce("content", F.lit(""))), F.col("region_id")).alias("line"))
    rows = tables.select("doc_id", F.lit(1).alias("part"), F.lit(0).alias("pos"), F.concat(F.lit("[TABLE] "), "region_id", F.lit("\n"), "matrix").alias("line"))
    both = lines.unionByName(rows)
    return both.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "pos", "line"))), lambda x: x["line"]), "\n").alias("context"))


def skill_fields(results: DataFrame) -> DataFrame:
    """Skill results as fields; a signature is a flag."""
    return results.select("doc_id", "pos", F.col("region_id").alias("field_key"), F.col("content").alias("raw_value"), F.col("content").alias("corrected_value"), F.when(F.col("skill_name") == "S6", "flag").otherwise("text").alias("data_type"), "confidence", F.array().cast("array<double>").alias("token_logprobs"), "region_id", F.lit(False).alias("was_retried"))


def fallback_fields(lines: DataFrame, factor: float = 0.7, least: float = 0.5) -> DataFrame:
    """Fields of the fallback reader's lines: discounted, and flagged below least."""
    c = F.round(F.col("score") * factor, 4)
    return lines.select("doc_id", "pos", F.format_string("text_line_%d", F.col("pos") + 1).alias("field_key"), F.col("text").alias("raw_value"), F.col("text").alias("corrected_value"), F.lit("text").alias("data_type"), c.alias("confidence"), (c < least).alias("is_flagged"))


def prompts(regions: DataFrame, templates: DataFrame) -> DataFrame:
    """Instructions of regions in reading order from templates(form_type, region_type, system, hint, example, schema)."""
    return regions.join(templates, ["form_type", "region_type"], "left").select("doc_id", "region_id", "order_idx", F.concat_ws("\n", "system", "hint", "example", "schema").alias("prompt"), pixel_budget(F.col("region_type")).alias("pixel_budget"))


def with_hint(prompt: Column, hint: Column, most: int = 200) -> Column:
    cut = F.when(F.length(hint) > most, F.concat(F.substring(hint, 1, most), F.lit("…"))).otherwise(hint)
    return F.when(X.blank(hint), prompt).otherwise(F.concat(prompt, F.lit("\n\nOCR: "), cut))


def in_order(answers: DataFrame, work: DataFrame) -> DataFrame:
    """Answers with the place of their task, in that order within each document.

    Both sides may come from exploded arrays, whose size the planner takes for that of the rows
    before; so the join is a merge, and no side of it goes to the driver.
    """
    return answers.join(work.select("doc_id", "region_id", "pos").hint("merge"), ["doc_id", "region_id"]).withColumn("turn", F.row_number().over(Window.partitionBy("doc_id").orderBy("pos", "region_id")))


def with_cells(results: DataFrame, cells: DataFrame) -> DataFrame:
    """Results of the readers, then those of the tables' cells, numbered anew within each document."""
    both = results.withColumn("__part", F.lit(0)).unionByName(cells.withColumn("__part", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("pos", F.row_number().over(Window.partitionBy("doc_id").orderBy("__part", "pos", "region_id")) - 1).drop("__part")


def read_twice(work: DataFrame, answers: Callable[[DataFrame], DataFrame], below: float = 0.70) -> DataFrame:
    """Answers to work, and where the first is less sure than below, the surer of two (the first if equal); n_reads says how many there were."""
    first = answers(work)
    weak = work.join(first.where(F.coalesce("confidence", F.lit(0.0)) < below).select("doc_id", "region_id"), ["doc_id", "region_id"], "left_semi")
    second = answers(weak).select("doc_id", "region_id", F.struct("content", "confidence").alias("__second"))
    both = first.join(second, ["doc_id", "region_id"], "left")
    best = better_of(F.struct("content", "confidence"), F.col("__second"))
    return both.withColumn("__best", F.when(F.col("__second").isNull(), F.struct("content", "confidence")).otherwise(best)).select("doc_id", "region_id", "__best.content", "__best.confidence", F.when(F.col("__second").isNull(), 1).otherwise(2).alias("n_reads"))


def two_pass_tables(tables: DataFrame, first: Callable[[DataFrame], DataFrame], second: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(cells, results): the structure that a first reading gives of every table, and what a second one reads in its full cells."""
    cells = table_cells(first(tables))
    return cells, second(cell_tasks(cells))


def approval_tables(cells: DataFrame) -> DataFrame:
    """(doc_id, region_id, approval): whether any cell of a table has a role in an approval."""
    role = F.coalesce(F.col("role"), F.lit(""))
    return cells.groupBy("doc_id", "region_id").agg(F.bool_or(role.contains("결재") | F.lower(role).contains("approv")).alias("approval"))


NO_CONTEXT = "(no text was read)"


def context_or_placeholder(documents: DataFrame, contexts: DataFrame) -> DataFrame:
    """(doc_id, context) of every document; one without any text has a placeholder."""
    return documents.select("doc_id").join(contexts, "doc_id", "left").withColumn("context", F.coalesce(F.nullif(F.trim("context"), F.lit("")), F.lit(NO_CONTEXT)))


def aggregated(results: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, fields): the official object that a model makes of what the skills read, and all fields.

    answers(doc_id, content, logprobs) has one answer for each document, with null content
    where the model failed. The object is the answer's JSON; it is a field of its own,
    aggregator_blob, after those of the skills, as sure as the answer's tokens. Without an
    answer, or without an object in it, the flat fields are all there is, and a warning says why.
    """
    flat = skill_fields(results)
    parsed = X.tolerant_json(F.col("content"))
    said = answers.select("doc_id", F.to_json(parsed).alias("assembled"), token_confidence(F.col("logprobs"), F.lit("text")).alias("confidence"), "logprobs", F.when(F.col("content").isNull(), "vlm_call_failed").when(parsed.isNull(), "집계 JSON 파싱 실패").alias("warning"))
    documents = results.select("doc_id").distinct().join(said, "doc_id", "left").select("doc_id", "assembled", F.coalesce("warning", F.when(F.col("confidence").isNull(), F.lit("vlm_call_failed"))).alias("warning"))
    blob = said.where("assembled is not null").select(
        "doc_id", F.lit(2**31 - 1).alias("pos"), F.lit("aggregator_blob").alias("field_key"), F.col("assembled").alias("raw_value"), F.col("assembled").alias("corrected_value"), F.lit("text").alias("data_type"), "confidence",
        F.coalesce("logprobs", F.array().cast("array<double>")).alias("token_logprobs"), F.lit(None).cast("string").alias("region_id"), F.lit(False).alias("was_retried"),
    )
    fields = flat.unionByName(blob)
    return documents, fields.withColumn("is_flagged", F.col("confidence") < least_confidence(F.col("data_type")))


def scored_fields(fields: DataFrame) -> DataFrame:
    """fields(field_key, data_type, token_logprobs) with confidence, the least one of their type, whether they miss it, and their number of tokens."""
    c = token_confidence(F.col("token_logprobs"), looked_up(F.col("data_type"), CLASS_OF_TYPE, "text"))
    least = least_confidence(F.col("data_type"))
    return fields.withColumns({"confidence": c, "least": least, "is_flagged": c < least, "n_tokens": F.greatest(F.size("token_logprobs"), F.lit(0))})


def table_rows(answers: DataFrame) -> DataFrame:
    """(doc_id, region_id, row, col, text, confidence): the cells of tables that were read as HTML, each as sure as its answer (0.5 without tokens)."""
    c = F.when(F.size("logprobs") > 0, token_confidence(F.col("logprobs"), F.lit("text"))).otherwise(0.5)
    return answers.select("doc_id", "region_id", F.explode(X.html_cells(F.col("content"))).alias("c"), c.alias("confidence")).select("doc_id", "region_id", "c.row", "c.col", "c.text", "confidence")
