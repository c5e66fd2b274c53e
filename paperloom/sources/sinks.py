"""Sinks: documents as JSON, XML and CSV, upserts, queues, training files and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def json_document(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def xml_document(columns: list[str], root: str = "document") -> Column:
    return F.to_xml(F.struct(*columns), {"rowTag": root})


def csv_rows(fields: DataFrame) -> DataFrame:
    """A row for each field, all as strings."""
    return fields.select(*[F.lower(F.col(c).cast("string")).alias(c) if t == "boolean" else F.col(c).cast("string").alias(c) for c, t in fields.dtypes if not t.startswith("array")])


def serialized(documents: DataFrame, columns: list[str], formats: tuple[str, ...] = ("json", "xml")) -> DataFrame:
    """documents with a column for each format asked for: json_output, xml_output, csv_output (one line of its values)."""
    out = documents
    if "csv" in formats:
        out = out.withColumn("csv_output", F.to_csv(F.struct(*columns)))
    if "json" in formats:
        out = out.withColumn("json_output", json_document(columns))
    return out.withColumn("xml_output", xml_document(columns)) if "xml" in formats else out


def titled(assembled: Column, title: Column) -> Column:
    """A JSON object with the document's title as its first key."""
    body = F.substring(assembled, F.lit(2), F.length(assembled))
    head = F.concat(F.lit('{"document_title":'), F.concat(F.lit('"'), F.regexp_replace(title, r'(["\\])', r"\\$1"), F.lit('"')))
    return F.when(title.isNull(), assembled).when(F.trim(body) == "}", F.concat(head, body)).otherwise(F.concat(head, F.lit(","), body))


def without_title(fields: DataFrame) -> DataFrame:
    """Fields but for a title that was read: titles come from the form."""
    return fields.where(F.coalesce(F.col("field_key") != "document_title", F.lit(True)))


def final_output(assembled: Column, fields: Column) -> Column:
    return F.coalesce(assembled, F.to_json(fields))


def latest(rows: DataFrame, key: str, at: str, *ties: str) -> DataFrame:
    """The last row of each key."""
    turn = Window.partitionBy(key).orderBy(F.desc(at), *[F.desc(t) for t in ties])
    return rows.withColumn("__turn", F.row_number().over(turn)).where("__turn = 1").drop("__turn")


def upserted(table: DataFrame, new: DataFrame, key: str = "doc_id", at: str = "processed_at") -> DataFrame:
    """table with the newest of the new rows in place of those of the same key."""
    return table.join(new.select(key).distinct(), key, "left_anti").unionByName(latest(new, key, at), allowMissingColumns=True)


def replaced(table: DataFrame, new: DataFrame, key: str = "doc_id") -> DataFrame:
    """table with all the new rows in place of those of their keys."""
    return table.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def written_or_kept(df: DataFrame, write, dead_letters: str) -> str | None:
    """write(df); if that fails, the rows go to the dead letters as JSON, and the error is returned."""
    try:
        write(df)
    except Exception as e:  # noqa: BLE001  whatever the target does, the rows are kept
        df.write.mode("append").json(dead_letters)
        return f"{type(e).__name__}: {e}"
    return None


def stage_table(df: DataFrame, folder: str, stage: str, trial: str) -> None:
    """A stage's rows of a trial, in place of those of the same trial."""
    df.withColumn("trial", F.lit(trial)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trial").parquet(f"{folder}/{stage}")


def training_file(pairs: DataFrame, path: str) -> None:
    pairs.write.mode("overwrite").json(path)


def response(outputs: DataFrame) -> DataFrame:
    """What a service answers: one object for each document, with its pages if it has any."""
    pages = outputs.where("parent_doc_id is not null").groupBy("parent_doc_id").agg(F.array_sort(F.collect_list(F.struct("page_number", "doc_id", "status", "processing_ms"))).alias("pages"), F.sum("processing_ms").alias("processing_ms"))
    single = outputs.where("parent_doc_id is null").select("doc_id", F.lit(None).cast("array<struct<page_number:int,doc_id:string,status:string,processing_ms:double>>").alias("pages"), F.col("processing_ms").cast("double").alias("processing_ms"))
    return single.unionByName(pages.withColumnRenamed("parent_doc_id", "doc_id").select("doc_id", F.col("pages").cast("array<struct<page_number:int,doc_id:string,status:string,processing_ms:double>>"), F.col("processing_ms").cast("double")))


def markdown(rows: DataFrame, title: str, most: int = 100) -> str:
    """A small result as a Markdown table of at most so many rows, made on the driver."""
    lines = [f"# {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + " --- |" * len(rows.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows.limit(most).collect()])


def html(rows: DataFrame, title: str, most: int = 100) -> str:
    from html import escape

    head = "".join(f"<th>{escape(c)}</th>" for c in rows.columns)
    body = "".join("<tr>" + "".join(f"<td>{escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in rows.limit(most).collect())
    return f"<!DOCTYPE html><title>{escape(title)}</title><h1>{escape(title)}</h1><table><tr>{head}</tr>{body}</table>"
