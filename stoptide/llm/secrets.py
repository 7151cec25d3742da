"""Credentials in texts, and who owns them. SQL functions only.

Base patterns find assignments, access keys and long hexadecimal strings. The method looks at
the whole corpus: the values of all candidates, also of a wider token pattern, are counted by
distinct owners and by distinct repositories, where equal texts of an owner count once. A value
that many owners have, or few owners in many repositories, is a copied example. A token that only
one owner has looks like a live credential and is added, in however many of its repositories it
is. What is left, a token in few repositories of few owners, is neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Patterns of the base kinds and of the wider candidates (fixed values).
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# a token of 20 or more characters with a digit and a letter, bounded on both sides
TOKEN = (r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])(?=[0-9_-]*[A-Za-z])"
         r"[A-Za-z0-9_-]{20,}(?![A-Za-z0-9_-])")
KINDS = ("assign", "access", "hex", "live")
ASSIGN_LENGTH = 12
MOST_OWNERS = 1
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 5    # of more than one owner
CHUNK = 64                  # matches whose places are found together
_SPAN = "struct<s:int,k:int,e:int,v:string>"


def spans(text: Column, pattern: str, kind: int, group: int = 0, shortest: int = 0) -> Column:
    """Array of (start, kind, end, value) of the pattern's matches, in code points.

    Matches are found from left to right without overlap. Their places are the running lengths
    of what lies between them and of the matches themselves. They are taken in chunks, first
    within each, then from chunk to chunk, as an array that grows by single entries is copied
    every time: so the time is linear in the matches.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(hits.alias("h"), values.alias("v"), gaps.alias("g"))
    none = F.array().cast(f"array<{_SPAN}>")

    def walked(chunk: Column) -> Column:
        """(length of the chunk, its spans from its beginning)"""
        return F.aggregate(
            chunk, F.struct(F.lit(0).alias("at"), none.alias("out")),
            lambda a, x: F.struct(
                (a["at"] + F.length(x["g"]) + F.coalesce(F.length(x["h"]), F.lit(0))).alias("at"),
                F.when(F.length(x["v"]) >= shortest, F.concat(a["out"], F.array(F.struct(
                    (a["at"] + F.length(x["g"])).alias("s"), F.lit(kind).alias("k"),
                    (a["at"] + F.length(x["g"]) + F.length(x["h"])).alias("e"),
                    x["v"].alias("v"))))).otherwise(a["out"]).alias("out")))

    def chunks(all_: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(all_), F.lit(CHUNK)),
                           lambda i: walked(F.slice(all_, i, F.lit(CHUNK))))

    def placed(parts: Column) -> Column:
        """The spans of all chunks, each moved by the length of those before it."""
        ends = F.aggregate(
            parts, F.array(F.lit(0)),
            lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + p["at"])))
        return F.flatten(F.zip_with(
            parts, F.slice(ends, F.lit(1), F.size(parts)), lambda p, at: F.transform(
                p["out"], lambda x: F.struct(
                    (x["s"] + at).alias("s"), x["k"].alias("k"), (x["e"] + at).alias("e"),
                    x["v"].alias("v")))))

    # each step is one element of an array, so that it is computed once and then read by name
    once = F.flatten(F.transform(F.transform(F.array(zipped), chunks), placed))
    return F.when(text.rlike(pattern), once).otherwise(none)


def may_hold(text: Column) -> Column:
    """Whether any candidate pattern occurs; other texts neither have spans nor are counted."""
    return (text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX) | text.rlike(TOKEN))


def base_spans(text: Column) -> Column:
    """The three base kinds, by start, then kind."""
    return F.array_sort(F.concat(
        spans(text, ASSIGN, 0, group=1, shortest=ASSIGN_LENGTH),
        spans(text, ACCESS, 1), spans(text, HEX, 2)))


def label(found: Column) -> Column:
    """`kind:start:end` of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"], x["e"])), ",")


def scan(df: DataFrame, text: str = "text", repository: str = "doc_id", owner: str = "source",
         most_owners: int = MOST_OWNERS, example_owners: int = EXAMPLE_OWNERS,
         example_repositories: int = EXAMPLE_REPOSITORIES, row: str = "__row") -> DataFrame:
    """(__row, base, found, n_live, n_examples) of each distinct row.

    `base` holds the base spans and `found` those with the added ones; candidates are counted as
    live (owner-specific) or as examples: of at least `example_owners` owners, or of more than
    `most_owners` in at least `example_repositories` repositories.

    `__row` is a 128-bit key of repository, owner and text (`row_key`); rows that repeat have
    one result. Null texts have no spans; a null owner counts as one of its own.
    """
    rows = df.select(row_key(df, text, repository, owner).alias(row),
                     F.coalesce(F.col(text), F.lit("")).alias("text"),
                     F.col(owner).cast("string").alias("owner"))
    # equal texts of an owner are one repository
    found = common.store(rows.select(
        row, "owner", F.xxhash64("text").alias("copy"), base_spans(F.col("text")).alias("base"),
        spans(F.col("text"), TOKEN, 3).alias("wide")), "secrets")
    each = found.select(row, "owner", "copy", F.explode(F.concat(
        F.transform("base", lambda x: x.withField("base", F.lit(True))),
        F.transform("wide", lambda x: x.withField("base", F.lit(False))))).alias("x")).select(
            row, "owner", "copy", "x.*").withColumn("hash", F.xxhash64("v"))
    # distinct repositories, then owners: partial results before every shuffle
    per_owner = each.select("hash", "owner", "copy").distinct().groupBy("hash", "owner").agg(
        F.count("*").alias("n"))
    stats = common.store(per_owner.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("n").alias("repositories")), "owners")
    live = F.col("owners") <= most_owners
    example = (F.col("owners") >= example_owners) | (
        ~live & (F.col("repositories") >= example_repositories))
    judged = each.join(stats, "hash").groupBy(row).agg(
        F.collect_set(F.when(live & ~F.col("base"), F.struct("s", "k", "e", "v")))
        .alias("added"),
        F.count_if(live).alias("n_live"), F.count_if(example).alias("n_examples"))
    once = found.dropDuplicates([row]).select(row, "base")
    none = F.array().cast(f"array<{_SPAN}>")
    joined = once.join(judged, row, "left")
    # a token that a base span holds already is not added again
    extra = F.filter(F.coalesce("added", none), lambda x: ~F.exists(
        "base", lambda b: (b["s"] <= x["s"]) & (b["e"] >= x["e"])))
    return joined.select(
        row, "base", F.array_sort(F.concat("base", extra)).alias("found"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_examples", F.lit(0)).alias("n_examples"))


def row_key(df: DataFrame, text: str, repository: str, owner: str) -> Column:
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
             for c in (repository, owner, text)]
    return F.md5(F.concat_ws("\u0001", *parts).cast("binary"))


def masked(text: Column, found: Column, mask: str = "[SECRET]") -> Column:
    """`text` with every run of overlapping spans replaced by `mask`."""
    done = F.aggregate(
        found, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, x: F.when(
            x["s"] >= a["at"],
            F.struct(x["e"].alias("at"), F.concat(
                a["out"], F.substring(text, a["at"] + 1, x["s"] - a["at"]),
                F.lit(mask)).alias("out"))).otherwise(
            F.struct(F.greatest(a["at"], x["e"]).alias("at"), a["out"].alias("out"))),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, done).otherwise(text)
