"""URL rules, and their spread over redirects and canonical links.

A rule decides the urls of its host and subdomains whose path begins with its path; the longest
rule wins. Pages without a rule take the decision of their aliases: urls that redirects and
canonical links connect. One explicit allow among the aliases lets all of them pass, else one
block blocks them.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .extract import RAW, _attributes, _tag_stop

# (host, path, verdict): the rules of the registered query (fixed values).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MARKUP = re.compile(r"<(?:(!--)|([a-zA-Z][^\s/>]*))")
# the time of a refresh, then its target, with or without `url=` and quotes
_REFRESH = re.compile(r"""(?is)\s*[\d.]+\s*[;,\s]\s*(?:url\s*=\s*)?(?:"([^"]*)|'([^']*)|(.*))""")
_SCHEME = "[A-Za-z][A-Za-z0-9+.-]*:"
# scheme, user, host, path, query of a url without fragment
_PARTS = rf"(?s)^({_SCHEME}//)((?:[^/?]*@)?)([^/?]*)([^?]*)(.*)$"
_BLANK = " \t\n\f\r"


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1),
                                  _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host_: Column, path_: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, else null.

    Rules are tried by the length of host and path together, then by text.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0], r[1])):
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"),
                                    F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def named_urls(page: str, own: str) -> list[str]:
    """What the canonical links and refreshes of a page name, resolved, in page order.

    The first `<base href>`, wherever it stands, is what relative targets are resolved against.
    Character references are decoded; comments and the texts of scripts, styles and the like hold
    no tags.
    """
    base, targets, at = None, [], 0
    while m := _MARKUP.search(page, at):
        if m[1]:
            stop = page.find("-->", m.end())
            if stop < 0:
                break
            at = stop + 3
            continue
        stop, tag = _tag_stop(page, m.end()), m[2].lower()
        if stop < 0:                                            # cut off
            break
        at = stop + 1
        if tag in ("link", "meta", "base"):
            given = {k: entities.unescape(v).strip(_BLANK) for k, v in
                     _attributes(page[m.end():stop]).items()}
            if tag == "base":
                base = base or given.get("href")
            elif tag == "link" and "canonical" in given.get("rel", "").lower().split():
                targets.append(given.get("href", ""))
            elif tag == "meta" and given.get("http-equiv", "").lower() == "refresh":
                found = _REFRESH.match(given.get("content", ""))
                if found:
                    targets.append((found[1] or found[2] or found[3] or "").strip(_BLANK))
        elif tag in RAW and page[stop - 1] != "/":
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            if end is None:
                break
            at = end.end()
    root = own if base is None else resolve(base, own) or own
    return [x for x in (resolve(t, root) for t in targets if t) if x]


def declared_links(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (a, b) from a page's url to what its canonical link or refresh names.

    Targets are resolved against the page's first `<base href>`, itself resolved against the
    page's url, or else against that url. Empty targets and those that `resolve` gives no url
    are left out. Both ends are in the form of `alias_of`.
    """
    may_name = F.col(html).rlike("(?i)canonical|refresh|&#")    # most pages hold none
    pages = df.where(F.col(url).isNotNull() & may_name).select(
        F.col(url).alias("a"), F.col(html).alias("page"))

    def run(texts: pa.Array, own: pa.Array) -> pa.Array:
        return pa.array([named_urls(t.as_py(), o.as_py())
                         for t, o in zip(texts, own, strict=True)], pa.list_(pa.string()))

    found = pages.select("a", F.explode(common.column(run, "array<string>")("page", "a"))
                         .alias("b"))
    return found.select(alias_of(F.col("a")).alias("a"), alias_of(F.col("b")).alias("b")).where(
        "b <> '' AND a <> b")


def resolve(target: str, base: str) -> str | None:
    """The url that `target` names on a page with the url `base`, by RFC 3986.

    A target is absolute if it begins with a scheme and `://`. None for schemes without `//`
    (mailto:, javascript:), which name no page, and for relative targets if `base` is not
    absolute. Dot segments stay; `alias_of` resolves them.
    """
    scheme = re.match(f"{_SCHEME}(//)?", target)
    if scheme:
        return target if scheme[1] else None
    base = base.partition("#")[0]
    parts = re.match(_PARTS, base)
    if not parts:
        return None
    root, path_ = "".join(parts.group(1, 2, 3)), parts[4]
    if target.startswith("//"):
        return parts[1][:-2] + target
    if target.startswith("/"):
        return root + target
    if target.startswith("?"):
        return root + path_ + target
    if target.startswith("#"):
        return base
    return root + (path_[:path_.rfind("/") + 1] or "/") + target


def alias_of(url: Column) -> Column:
    """The url without its fragment; scheme and host in lower case, dot segments resolved."""
    url = F.regexp_replace(url, r"(?s)#.*$", "")
    scheme, user, host_, path_, query = [F.regexp_extract(url, _PARTS, k) for k in range(1, 6)]
    dots = path_.rlike(r"/\.\.?(/|$)")
    none = F.array().cast("array<string>")
    # a last dot segment leaves the `/` before it
    segments = F.split(F.regexp_replace(path_, r"/(\.\.?)$", "/$1/"), "/", -1)
    kept = F.aggregate(segments, none, lambda out, x: F.when(x == ".", out).when(
        x == "..", F.slice(out, F.lit(1), F.greatest(F.lit(1), F.size(out) - 1))).otherwise(
        F.concat(out, F.array(x))))
    return F.when(url.rlike(_PARTS), F.concat(
        F.translate(scheme, _UPPER, _LOWER), user, F.translate(host_, _UPPER, _LOWER),
        F.when(dots, F.array_join(kept, "/")).otherwise(path_), query)).otherwise(url)


def judge(df: DataFrame, rules: list[tuple[str, str, str]] | None = None,
          redirects: DataFrame | None = None, page_id: str = "page_id", url: str = "url",
          html: str | None = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, decided_by) of every row of `df`.

    `redirects` (a, b) adds redirect pairs to what the pages declare. Null urls and urls without
    `://` have empty host and path, fit no rule and pass. Pages that nothing decides pass.
    Equal rows are judged alike. Other columns are not read.
    """
    rules = RULES if rules is None else rules
    own = df.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    own = own.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    own = own.withColumn("fit", rule(F.col("host"), F.col("path"), rules))
    edges = declared_links(df, url, html) if html else None
    if redirects is not None:
        given = redirects.select(alias_of(F.col("a")).alias("a"), alias_of(F.col("b")).alias("b"))
        edges = given if edges is None else edges.union(given)
    if edges is None:
        out = own.withColumn("spread", F.lit(None).cast("string"))
    else:
        parts = common.store(common.components(edges), "aliases")
        verdict = rule(host(F.col("node")), path(F.col("node")), rules)["verdict"]
        groups = parts.select("component", verdict.alias("v")).groupBy("component").agg(
            F.when(F.max(F.col("v") == "allow"), "allow").when(
                F.max(F.col("v") == "block"), "block").alias("spread")).where(
                    "spread IS NOT NULL")
        groups = common.store(groups, "groups")
        decided = common.store(parts.join(groups, "component").select("node", "spread"),
                               "decided")
        out = own.withColumn("node", alias_of(F.col("url"))).join(decided, "node", "left")
    return out.select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", "spread", F.lit("allow")).alias("verdict"),
        F.when(F.col("fit").isNotNull(), "rule").when(F.col("spread").isNotNull(), "alias")
        .otherwise("default").alias("decided_by"))
