"""String, date, number and JSON functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Java's \d, \s and \w are ASCII only unless told otherwise.
UNICODE = "(?U)"


def begins_with_match(value: Column, pattern: str) -> Column:
    """Whether pattern matches at the start of value (not necessarily up to its end)."""
    return value.rlike(f"{UNICODE}^(?:{pattern})")


def blank(value: Column) -> Column:
    """Null, or nothing but white space."""
    return value.isNull() | (F.trim(value) == "")


def empty_token(value: Column) -> Column:
    """Null, or one of the literals that stand for nothing."""
    return value.isNull() | value.isin("", "None", "{}", "[]")


def without_blanks(value: Column) -> Column:
    return F.trim(F.replace(value, F.lit(" "), F.lit("")))


def number(value: Column) -> Column:
    """A double, with thousands separators allowed; null if it is none."""
    return F.trim(F.replace(value.cast("string"), F.lit(","), F.lit(""))).try_cast("double")


def template_normalized(value: Column, pattern: str, template: str, groups: int) -> Column:
    """The template with {n} and {n:02d} filled by the groups of the first match; null without one."""
    out = F.lit(template)
    for k in range(1, groups + 1):
        group = F.regexp_extract(value, UNICODE + pattern, k)
        padded = F.when(group.try_cast("int").isNotNull(), F.lpad(group.try_cast("int").cast("string"), 2, "0")).otherwise(group)
        # lpad cuts what is longer
        padded = F.when(F.length(group) > 2, group).otherwise(padded)
        out = F.replace(F.replace(out, F.lit(f"{{{k}:02d}}"), padded), F.lit(f"{{{k}}}"), group)
    return F.when(value.rlike(UNICODE + pattern), out)


def parsed_date(value: Column, korean: bool = True, old_century: bool = True) -> Column:
    """A date written in one of the usual ways; null otherwise.

    A date in Korean words may stand anywhere, and if it is no day of the calendar, no other
    way is tried. Two-digit years from 69 on are of the last century.
    """
    text = F.trim(value)
    tries = [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in ("yyyy-M-d", "yyyy.M.d", "yyyy/M/d")]
    short = r"^\d{2}\.\d{1,2}\.\d{1,2}$"
    year = F.substring(text, 1, 2).try_cast("int")
    century = F.when(year >= 69, "19").otherwise("20") if old_century else F.lit("20")
    tries.append(F.when(text.rlike(short), F.try_to_timestamp(F.concat(century, text), F.lit("yyyy.M.d")).cast("date")))
    plain = F.coalesce(*[F.when(text.rlike(r"^\d"), t) for t in tries])
    if not korean:
        return plain
    words = UNICODE + r"(\d{4})\s*년\s*(\d{1,2})\s*월\s*(\d{1,2})\s*일"
    spelt = F.concat_ws("-", *[F.regexp_extract(text, words, k) for k in (1, 2, 3)])
    return F.when(text.rlike(words), F.try_to_timestamp(spelt, F.lit("yyyy-M-d")).cast("date")).otherwise(plain)


def date_order_holds(dates: list[Column]) -> Column:
    """Whether the dates that are there do not decrease; fewer than two do. A fold, so that each date is parsed once."""
    if len(dates) < 2:
        return F.lit(True)
    start = F.struct(F.lit(None).cast("date").alias("last"), F.lit(True).alias("holds"))
    return F.aggregate(
        F.array(*dates),
        start,
        lambda s, d: F.struct(F.coalesce(d, s["last"]).alias("last"), (s["holds"] & F.coalesce(s["last"] <= d, F.lit(True))).alias("holds")),
        lambda s: s["holds"],
    )


def fenced(text: Column) -> Column:
    """What stands in the first code fence; null without one."""
    return F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*\n?(.*?)\n?```", 1), F.lit(""))


def balanced_part(text: Column, opening: str = "{", closing: str = "}") -> Column:
    """What stands from the first opening sign to the one that balances it, by a fold over its signs; null without one."""
    start = F.locate(opening, text)
    signs = F.split(F.substring(text, start, F.length(text)), "")
    state = F.aggregate(
        signs,
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("seen"), F.lit(0).alias("end")),
        lambda s, c: F.struct(
            (s["depth"] + F.when(c == opening, 1).when(c == closing, -1).otherwise(0)).alias("depth"),
            (s["seen"] + 1).alias("seen"),
            F.when((s["end"] == 0) & (c == closing) & (s["depth"] == 1), s["seen"] + 1).otherwise(s["end"]).alias("end"),
        ),
    )
    return F.when((start > 0) & (state["end"] > 0), F.substring(text, start, state["end"]))


def tolerant_json(text: Column, objects_only: bool = True) -> Column:
    """A variant: the text itself, else its code fence, else its first balanced object (or list); null if none parses.

    The first of these that parses is the answer: with objects_only, null if it is no object.
    """
    tiers = [text, fenced(text), balanced_part(text), *([] if objects_only else [balanced_part(text, "[", "]")])]
    found = F.coalesce(*[F.try_parse_json(F.trim(t)) for t in tiers])
    return F.when(is_object(found), found) if objects_only else found


def is_object(value: Column) -> Column:
    """Whether a variant is an object."""
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def json_string(text: Column) -> Column:
    """The text as JSON writes it."""
    whole = F.to_json(F.struct(text.alias("v")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def any_unwrapped(content: Column, field_key: Column) -> Column:
    """A model's answer as plain text: parsed if it can be, without a wrapper of the field's key and then of any only key; lists and objects as JSON."""
    text = F.trim(F.coalesce(content, F.lit("")))
    parsed = F.coalesce(*[F.try_parse_json(F.trim(t)) for t in (text, fenced(text), balanced_part(text))])
    once = only_value(parsed, field_key)
    inner = F.coalesce(only_value(once, None), once)
    plain = F.try_variant_get(inner, "$", "string")
    kind = F.schema_of_variant(inner)
    return F.when(parsed.isNull() | (kind == "VOID"), text).when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.to_json(inner)).otherwise(plain)


def only_value(value: Column, key: Column | None) -> Column:
    """What an object has under its only key, if that is key (or whatever it is); otherwise the value as it is."""
    # only keys matter, so the object is read as a map of variants; a transform makes it once for all that reads it
    entries = F.transform(F.array(value), lambda v: F.struct(v.alias("v"), F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")).alias("in")))

    def opened(e: Column) -> Column:
        fits = F.size(e["in"]) == 1
        if key is not None:
            fits = fits & (F.get(e["in"], F.lit(0))["key"] == key)
        return F.when(F.coalesce(is_object(e["v"]) & fits, F.lit(False)), F.get(e["in"], F.lit(0))["value"]).otherwise(e["v"])

    return F.get(F.transform(entries, opened), F.lit(0))


def json_at(document: Column, path: str, kind: str = "string") -> Column:
    """The value at a dotted path, where a number is a place in a list."""
    steps = "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in path.split("."))
    return F.try_variant_get(document, f"${steps}", kind)


def shortened(text: Column, most: int = 240) -> Column:
    """One line of at most most characters and an ellipsis."""
    line = F.trim(F.replace(text, F.lit("\n"), F.lit(" ")))
    return F.when(F.length(line) > most, F.concat(F.substring(line, 1, most), F.lit("…"))).otherwise(line)


def html_cells(html: Column) -> Column:
    """array<struct<row, col, text>> of the cells of an HTML table."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(
        rows,
        lambda r, i: F.transform(
            F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)),
            lambda c, j: F.struct(i.alias("row"), j.alias("col"), F.trim(F.regexp_replace(c, "<[^>]+>", "")).alias("text")),
        ),
    )
    return F.flatten(cells)


def codes_in(text: Column, patterns) -> Column:
    """array<struct<code_type, raw>>: every code of the patterns, one for each raw text, of the first pattern that finds it."""
    def named(kind: str):
        return lambda r: F.struct(F.lit(kind).alias("code_type"), r.alias("raw"))

    def unlike(found: Column):
        return lambda n: ~F.array_contains(F.transform(found, lambda f: f["raw"]), n["raw"])

    found = None
    for pattern, kind in patterns:
        new = F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))), named(kind))
        found = new if found is None else F.concat(found, F.filter(new, unlike(found)))
    return found


def cell_place(region: Column, table: Column) -> Column:
    """struct<row, col> of a cell's region id, null if it isn't one of the table's."""
    row, col = (F.regexp_extract(region, r"_r(\d+)c(\d+)$", k).try_cast("int") for k in (1, 2))
    return F.when(region.startswith(F.concat(table, F.lit("_r"))) & row.isNotNull(), F.struct(row.alias("row"), col.alias("col")))


def last_step(path: Column) -> Column:
    return F.element_at(F.split(path, r"\."), -1)


def field_of_path(path: Column) -> Column:
    """The field that a path of an assembled result comes from; null for nested ones without."""
    item = F.regexp_extract(path, r"^checklist_items\[(\d+)\]", 1)
    return (
        F.when(item != "", F.concat(F.lit("result_item_"), (item.try_cast("int") + 1).cast("string")))
        .when(path.startswith("writer"), F.lit("writer_block"))
        .when(~path.contains(".") & ~path.contains("["), path)
    )


def leaf_type(path: Column) -> Column:
    """The type that a path's words suggest; the first that fits."""
    p = F.lower(path)

    def has(*words: str) -> Column:
        out = p.contains(words[0])
        for w in words[1:]:
            out = out | p.contains(w)
        return out

    return (
        F.when(has("nsn", "k_nsn", "unit_code", "equipment_id"), "code").when(has("total", "price", "amount"), "amount").when(has("date"), "date")
        .when(has("quantity", "qty", "stock"), "quantity").when(has("result"), "handwritten").when(has("seal", "stamp"), "seal")
        .when(has("signature"), "signature").when(has("code", "number", "id"), "code").otherwise("text")
    )


def extension_of(path: Column, default: str = "png") -> Column:
    found = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return F.when(found.isin("jpg", "jpeg", "png", "tiff", "tif", "pdf"), found).otherwise(F.lit(default))


def page_id(doc_id: Column, page: Column) -> Column:
    return F.format_string("%s_p%02d", doc_id, page)
