"""Corrections from dictionaries: aliases, prefixes, nearest entries and ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import RANKS

CUTOFF = 2


def nearest(value: Column, entries: Sequence[str], cutoff: int = CUTOFF) -> Column:
    """The first of the entries at the least edit distance, if that is at most cutoff; the value itself if it is one of them; else null.

    The entries are a fixed list in the plan; for a dictionary of any size use nearest_rows.
    """
    best = F.array_min(F.array(*[F.struct(F.levenshtein(value, F.lit(e)).alias("d"), F.lit(k).alias("k"), F.lit(e).alias("e")) for k, e in enumerate(entries)]))
    return F.when(value.isin(*entries), value).when(best["d"] <= cutoff, best["e"])


def nearest_rows(values: DataFrame, dictionary: DataFrame, cutoff: int = CUTOFF) -> DataFrame:
    """(value, entry, distance) for distinct values against dictionary(ord, entry).

    Strings within cutoff edits of each other share one of cutoff + 1 consecutive parts of
    the entry, at most cutoff places apart: an equi-join on these parts finds candidates of
    any dictionary without a cross product. Entries too short to be parted join by length.
    """
    parts = cutoff + 1
    cut = [F.floor(F.length("entry") * k / parts).cast("int") for k in range(parts + 1)]
    long_entry = F.length("entry") >= parts
    keys = F.array(*[F.struct((cut[k] + 1).alias("at"), F.substring(F.col("entry"), cut[k] + 1, cut[k + 1] - cut[k]).alias("part")) for k in range(parts)])
    sides = dictionary.withColumn("key", F.explode(F.when(long_entry, keys).otherwise(F.array(F.struct(F.lit(0).alias("at"), F.lit("").alias("part"))))))
    sides = sides.select("ord", "entry", F.col("key.at").alias("at"), F.col("key.part").alias("part"), F.length("key.part").alias("size"))
    sizes = [r[0] for r in sides.where("at > 0").select("size").distinct().collect()]  # lengths of parts, a few
    def grams_of(size: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("value") - size + 1))
        return F.transform(places, lambda i: F.struct(i.alias("v_at"), F.substring(F.col("value"), i, F.lit(size)).alias("part")))

    grams = F.flatten(F.array(*[grams_of(s) for s in sizes])) if sizes else F.array().cast("array<struct<v_at:int,part:string>>")
    distinct = values.select("value").where("value is not null").distinct()
    seen = distinct.withColumn("g", F.explode(grams)).select("value", "g.v_at", "g.part")
    found = seen.join(sides.where("at > 0"), "part").where(F.abs(F.col("v_at") - F.col("at")) <= cutoff).select("value", "ord", "entry")
    short = distinct.where(F.length("value") <= 2 * cutoff).withColumn("part", F.lit("")).join(sides.where("at = 0"), "part").select("value", "ord", "entry")
    scored = found.unionByName(short).distinct().withColumn("distance", F.levenshtein("value", "entry")).where(F.col("distance") <= cutoff)
    best = scored.groupBy("value").agg(F.min_by(F.struct("entry", "distance"), F.struct("distance", "ord")).alias("b"))
    return best.select("value", "b.entry", "b.distance")


def rank_normalized(raw: Column) -> Column:
    """The rank itself, the first nearest within two edits, or what was there; any two signs are within two edits of the first."""
    trimmed = F.trim(raw)
    return F.when(raw.isNull() | (trimmed == ""), raw).otherwise(F.coalesce(nearest(trimmed, RANKS), raw))


def canonical(value: Column, aliases: dict[str, str]) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in aliases.items() for x in p]), F.trim(value)), value) if aliases else value


def city_of(address: Column, cities: Sequence[str], aliases: dict[str, str], pattern: str | None = None) -> Column:
    """The first city that begins the address, else that of the first alias that does, else what the pattern finds."""
    text = F.trim(address)
    out = F.lit(None).cast("string")
    for alias, city in reversed(list(aliases.items())):
        out = F.when(text.startswith(alias), city).otherwise(out)
    for city in reversed(list(cities)):
        out = F.when(text.startswith(city), city).otherwise(out)
    return out if pattern is None else F.coalesce(out, F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")))


def first_prefix(values: DataFrame, prefixes: DataFrame) -> DataFrame:
    """values(value) with the target of the first, by ord, of prefixes(ord, prefix, target) that begins them.

    Joined on the prefix's length and text, so that any number of prefixes is an equi-join.
    """
    lengths = [r[0] for r in prefixes.select(F.length("prefix")).distinct().collect()]  # a few
    heads = values.select("value").distinct().withColumn("prefix", F.explode(F.array(*[F.substring("value", 1, n) for n in lengths])))
    hit = heads.join(prefixes, "prefix").groupBy("value").agg(F.min_by("target", "ord").alias("target"))
    return values.join(hit, "value", "left")


def location_corrected(location: Column, address: Column, cities: Sequence[str], aliases: dict[str, str]) -> Column:
    """The alias's canonical name; the address's city wins over it."""
    return F.coalesce(city_of(address, cities, aliases), canonical(location, aliases))


def corrected(documents: DataFrame, dictionaries: dict) -> DataFrame:
    """documents with business_location, industry_class_number and issuing_office corrected; far values stay."""
    d = dictionaries
    return documents.withColumns({
        "business_location": location_corrected(F.col("business_location"), F.col("address"), d["cities"], d["aliases"]),
        "industry_class_number": F.coalesce(nearest(F.trim("industry_class_number"), d["codes"]), "industry_class_number"),
        "issuing_office": F.coalesce(nearest(F.trim("issuing_office"), d["offices"]), "issuing_office"),
    })
