"""Sources: scanned files, requests, rule files and the outputs of earlier runs."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import extension_of, page_id

SCANS = "*.{jpg,jpeg,png,tiff,tif,pdf,JPG,JPEG,PNG,TIFF,TIF,PDF}"
PDF_MAGIC = "%PDF"


def scanned_files(spark: SparkSession, folder: str, by_name: bool = False) -> DataFrame:
    """(doc_id, path, file_ext, is_pdf, content) of the scans in a folder; in order of their paths if that is asked for."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", SCANS).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    files = files.orderBy("path") if by_name else files
    return files.select(F.regexp_replace(name, r"\.[^.]*$", "").alias("doc_id"), "path", extension_of(F.col("path")).alias("file_ext"), is_pdf(F.col("content")).alias("is_pdf"), "content")


def is_pdf(content: Column) -> Column:
    return F.substring(content, 1, 4) == F.lit(PDF_MAGIC).cast("binary")


def requests(spark: SparkSession, path: str) -> DataFrame:
    """Documents of JSON requests, one on a line, with the image in base 64."""
    schema = "doc_id string, image_base64 string, file_ext string, dpi_hint int, source_type string"
    return spark.read.schema(schema).json(path).withColumn("content", F.unbase64("image_base64")).drop("image_base64")


def pdf_pages(documents: DataFrame, renderer) -> DataFrame:
    """(doc_id, parent_doc_id, page_number, total_pages, content, error): a row for each page that renderer(content) gives.

    A document that can't be rendered, or has no pages, gives one row with the error.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for doc_id, content in zip(frame.doc_id, frame.content, strict=True):
                try:
                    pages = list(renderer(content))
                    if not pages:
                        raise ValueError("no pages")
                    yield pd.DataFrame({"parent_doc_id": doc_id, "page_number": range(1, len(pages) + 1), "total_pages": len(pages), "content": pages, "error": None})
                except Exception as e:  # noqa: BLE001  a broken file is a result
                    yield pd.DataFrame({"parent_doc_id": [doc_id], "page_number": [0], "total_pages": [0], "content": [None], "error": [str(e)]})

    rows = documents.select("doc_id", "content").mapInPandas(run, "parent_doc_id string, page_number int, total_pages int, content binary, error string")
    return rows.withColumn("doc_id", page_id(F.col("parent_doc_id"), F.col("page_number")))


def scan_warnings(text_length: Column, image_dpi: Column) -> Column:
    short = F.when(text_length < 50, F.format_string("little text: %d", text_length))
    coarse = F.when(image_dpi < 150, F.format_string("low resolution: %d dpi", image_dpi))
    return F.array_compact(F.array(short, coarse))


def rule_files(spark: SparkSession, paths: dict[str, str]) -> dict[str, list[dict]]:
    """Rules by form type, from YAML files that Spark reads; a missing key is no rules."""
    import yaml

    out = {}
    for form, path in paths.items():
        text = spark.read.text(path, wholetext=True).first()
        out[form] = (yaml.safe_load(text.value) or {}).get("rules", []) if text else []
    return out


def pattern_file(spark: SparkSession, path: str) -> tuple[list[dict], list[dict]]:
    """The patterns of data types and of field keys in a YAML file that Spark reads; a missing key is no patterns."""
    import yaml

    text = spark.read.text(path, wholetext=True).first()
    parsed = (yaml.safe_load(text.value) or {}) if text else {}
    return parsed.get("field_type_patterns") or [], parsed.get("field_key_patterns") or []


def prompt_examples(spark: SparkSession, files: dict[str, dict]) -> DataFrame:
    """(form_type, field_key, ord, description, response, common_rules) from parsed example files by form type.

    A file has one example, or a list of them by field key with rules common to all. The
    first example of a list is that of the form as well: field_key is null there.
    """
    rows = []
    for form, data in files.items():
        listed, common = data.get("examples"), data.get("common_rules")
        if isinstance(listed, list) and listed:
            rules = common.strip() or None if isinstance(common, str) else None
            by_key = {e["field_key"]: e for e in listed if isinstance(e, dict) and e.get("field_key")}
            chosen = [(None, next(iter(by_key.values())))] if by_key else []
            chosen += by_key.items()
        else:
            rules, chosen = None, [(None, data)]
        rows += [(form, key, k, e.get("example_description", ""), e.get("example_response", ""), rules) for k, (key, e) in enumerate(chosen)]
    return spark.createDataFrame(rows, "form_type string, field_key string, ord int, description string, response string, common_rules string")


def example_of(regions: DataFrame, examples: DataFrame) -> DataFrame:
    """regions(form_type, field_key, ...) with the example of their field, else of their form."""
    own = examples.where("field_key is not null").select("form_type", "field_key", F.struct("description", "response").alias("__own"), F.col("common_rules").alias("__rules"))
    whole = examples.where("field_key is null").select("form_type", F.struct("description", "response").alias("__whole"))
    out = regions.join(own, ["form_type", "field_key"], "left").join(whole, "form_type", "left")
    return out.withColumns({"example": F.coalesce("__own", "__whole"), "common_rules": F.col("__rules")}).drop("__own", "__whole", "__rules")


def dictionary(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A dictionary with its order in ord."""
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"ord int, {columns}")


def schema_files(spark: SparkSession, folder: str) -> DataFrame:
    """(schema_id, version, deprecated, schema, load_pos) of JSON schema files, each version once, in order of their paths."""
    files = spark.read.text(folder, wholetext=True).withColumn("path", F.input_file_name())
    v = F.try_parse_json("value")
    rows = files.select("path", "value", F.try_variant_get(v, '$["$id"]', "string").alias("schema_id"), F.coalesce(*[F.try_variant_get(v, f'$["{k}"]', "string") for k in ("x-version", "version")], F.lit("0.0.0")).alias("version"), F.coalesce(F.try_variant_get(v, '$["x-deprecated"]', "boolean"), F.lit(False)).alias("deprecated"))
    first = rows.where("schema_id is not null").groupBy("schema_id", "version").agg(F.min_by(F.struct("path", "deprecated", F.col("value").alias("schema")), "path").alias("r"))
    return first.select("schema_id", "version", "r.deprecated", "r.schema", F.col("r.path").alias("load_pos"))


def latest_schemas(schemas: DataFrame) -> DataFrame:
    """The last loaded version of each schema that isn't deprecated."""
    return schemas.where("not deprecated").groupBy("schema_id").agg(F.max_by(F.struct("version", "schema"), "load_pos").alias("s")).select("schema_id", "s.*")


# Other names of schemas.
SCHEMA_ALIASES = {"other": "official_document", "unknown": "_fallback"}


def schema_of(schemas: DataFrame, name: str, version: str | None = None) -> DataFrame:
    """The last loaded schema of a name (an alias, or name:version) that isn't deprecated and whose version is, or begins with, the one asked for; at most one row."""
    if version is None and ":" in name:
        name, version = name.split(":", 1)
    fits = (F.col("schema_id") == SCHEMA_ALIASES.get(name, name)) & ~F.col("deprecated")
    if version is not None:
        fits = fits & ((F.col("version") == version) | F.col("version").startswith(version.lstrip("v")))
    one = schemas.where(fits).agg(F.max_by(F.struct("schema_id", "version", "schema"), "load_pos").alias("s"))
    return one.where("s is not null").select("s.*")


def listed_schemas(schemas: DataFrame) -> DataFrame:
    """(schema_id, version, deprecated) of all, a schema without a version as 0.0.0."""
    return schemas.select("schema_id", F.coalesce("version", F.lit("0.0.0")).alias("version"), F.coalesce("deprecated", F.lit(False)).alias("deprecated"))


def assembly_rules(schema_id: str, schema: str, keyword: str = "x-assembly-rules") -> list[tuple]:
    """(schema_id, ord, field_key, path) of a schema's text."""
    return [(schema_id, k, field, path) for k, (field, path) in enumerate((json.loads(schema).get(keyword) or {}).items())]


def run_outputs(spark: SparkSession, folder: str, schema: str, name: str = "*.json") -> DataFrame:
    """JSON files anywhere under a folder with the path of each; unparseable ones are left out."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", name).json(folder)
    return rows.withColumn("path", F.input_file_name())


def document_of_path(path: Column, root: str) -> Column:
    """The folder of a document, or of a PDF's page, below the root of a run."""
    below = F.regexp_replace(path, "^.*?" + root.rstrip("/") + "/", "")
    return F.regexp_extract(below, r"^([^/]+(?:/p\d+)?)", 1)


def template_rows(spark: SparkSession, templates: list[dict]) -> DataFrame:
    """Template fields from parsed template files; a file without versions is one version of itself."""
    rows = []
    for t in templates:
        for n, v in enumerate(t.get("versions") or [t]):
            size = v.get("page_size") or t.get("page_size") or [0, 0]
            rows += [(t["form_type"], n, str(v.get("version", "")), v.get("form_identifier"), int(size[0]), int(size[1]), k, f.get("field_key"), f.get("region_type", "text"), *(int(x) for x in f["bbox"])) for k, f in enumerate(v.get("fields", []))]
    return spark.createDataFrame(rows, "form_type string, version_ord int, version string, form_identifier string, page_w int, page_h int, ord int, field_key string, region_type string, x1 int, y1 int, x2 int, y2 int")


def sub_schema(schema: dict, field_key: str) -> dict:
    """The part of a JSON schema that one field is asked for with, pruned on the driver.

    A numbered checklist item has the item's schema with its number fixed; a path of two
    steps has its leaf alone; a path of one, or a property of the field's name, has that
    property; anything else has the whole schema.
    """
    properties = schema.get("properties") or {}
    if field_key.startswith("result_item_") and field_key.removeprefix("result_item_").isdigit():
        item = schema.get("x-checklist-item-schema") or (properties.get("checklist_items") or {}).get("items")
        if item:
            number = {"type": "integer", "const": int(field_key.removeprefix("result_item_"))}
            return item | {"properties": (item.get("properties") or {}) | {"item_number": number}}
    top, *rest = ((schema.get("x-assembly-rules") or {}).get(field_key) or field_key).split(".")
    inner = properties.get(top)
    if rest and inner and rest[-1] in (inner.get("properties") or {}):
        return {"type": "object", "properties": {rest[-1]: inner["properties"][rest[-1]]}, "required": [rest[-1]]}
    return inner or properties.get(field_key) or schema


def tolerant(documents: DataFrame, text: str = "value", into: str = "parsed") -> DataFrame:
    """documents with their JSON text as a variant; null where it can't be parsed."""
    return documents.withColumn(into, F.try_parse_json(text))


def new_folders(after: DataFrame, before: DataFrame) -> DataFrame:
    """Folders of runs that are there after a run and weren't before."""
    return after.select("folder").subtract(before.select("folder"))
