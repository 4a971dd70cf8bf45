"""Scalar text functions, JVM-side but for Unicode normal forms and LaTeX."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# --- Fixed values of the DOI and address rules.
APS_CASE = {"physrevlett": "PhysRevLett", "physrevd": "PhysRevD", "physrevc": "PhysRevC", "physrevx": "PhysRevX", "revmodphys": "RevModPhys"}
FIGURE_CASE = ["physrevlett", "physrevd", "physrevc"]
SCHEMES = ["http://", "https://", "ftp://", "ftps://", "sftp://", "www.", "ftp."]
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}
CC_URI = r"https?://creativecommons\.org/licenses/([a-z-]+)/([0-9.]+)"
RESTRICTIVE = r"non-?commercial|no-?derivati|share-?alike|by-nc|by-nd|by-sa"
PROSE_BY = r"creative commons attribution|cc[\s\-]?by\b"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def slug(name: Column | str, null: str = "") -> Column:
    """Lower case, other than a-z0-9 as single hyphens, none at the ends, then 40 characters; a null name gives ``null``."""
    return F.coalesce(F.substring(F.btrim(F.regexp_replace(F.lower(_c(name)), "[^a-z0-9]+", "-"), F.lit("-")), 1, 40), F.lit(null))


def basename(path: Column | str) -> Column:
    return F.substring_index(_c(path), "/", -1)


def local_href(href: Column | str) -> Column:
    """Whether an address is a file of the document's own package."""
    h = F.trim(F.coalesce(_c(href), F.lit("")))
    outer = F.lit(False)
    for s in SCHEMES:
        outer = outer | F.startswith(F.lower(h), F.lit(s))
    return (h != "") & ~F.startswith(h, F.lit("#")) & ~outer & ~F.contains(F.substring_index(h, "/", 1), F.lit(":"))


def doi_variants(doi: Column | str, figures: bool = False) -> Column:
    """A DOI and the spellings a case-sensitive index has of it; ``figures``: the shorter list of the figure source."""
    d = _c(doi)
    part = lambda p, i: F.regexp_extract(d, p, i)
    # fixed values: the spellings of two publishers' identifiers
    aps, jhep = r"^(10\.1103)/([a-z]+)\.(.+)$", r"^(10\.1007)/jhep(\d+)\((\d+)\)(\d+)$"
    cased = F.lit(None).cast("string")
    for low, proper in APS_CASE.items():
        if not figures or low in FIGURE_CASE:
            cased = F.when(part(aps, 2) == low, F.lit(proper)).otherwise(cased)
    spelled = F.when(cased.isNotNull(), F.concat(part(aps, 1), F.lit("/"), cased, F.lit("."), part(aps, 3)))
    journal = F.when(d.rlike(jhep), F.concat(part(jhep, 1), F.lit("/JHEP"), part(jhep, 2), F.lit("("), part(jhep, 3), F.lit(")"), part(jhep, 4)))
    return F.array_compact(F.array(d, spelled, *([] if figures else [journal])))


def native_urls(doi: Column | str, journal: Column | str) -> Column:
    """Candidate addresses of the XML at publishers that serve it openly, by DOI prefix."""
    d = _c(doi)
    is_ = lambda p: F.startswith(d, F.lit(p))
    number = lambda p: F.nullif(F.regexp_extract(d, p, 1), F.lit(""))
    name = F.replace(F.trim(F.regexp_replace(F.lower(F.coalesce(_c(journal), F.lit(""))), "^frontiers (in|of) ", "")), F.lit(" "), F.lit("-"))
    # fixed values: where each publisher serves its files
    urls = [
        F.when(is_("10.1371/"), F.concat(F.lit("https://journals.plos.org/plosone/article/file?id="), d, F.lit("&type=manuscript"))),
        F.when(is_("10.7554/"), F.concat(F.lit("https://elifesciences.org/articles/"), number(r"(?i)elife\.(\d+)"), F.lit(".xml"))),
        F.when(is_("10.12688/") | is_("10.21956/"), F.concat(F.lit("https://f1000research.com/extapi/article/xml?doi="), d)),
        F.when(is_("10.7717/"), F.concat(F.lit("https://peerj.com/articles/"), number(r"(?i)peerj\.(\d+)"), F.lit(".xml"))),
        F.when(is_("10.1098/"), F.concat(F.lit("https://royalsocietypublishing.org/doi/full-xml/"), d)),
        F.when(is_("10.3390/"), F.concat(F.lit("https://www.mdpi.com/article/"), d, F.lit("/xml"))),
        F.when(is_("10.3389/") & (name != ""), F.concat(F.lit("https://www.frontiersin.org/journals/"), name, F.lit("/articles/"), d, F.lit("/xml"))),
    ]
    return F.array_compact(F.array(*urls))


def message_kind(message: Column | str) -> Column:
    """A finding's kind: each token with a digit as N, and 90 characters."""
    return F.substring(F.regexp_replace(_c(message), r"\S*\d\S*", "N"), 1, 90)


def normalised_space(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_c(text), r"\s+", " "))


def person(name: Column | str) -> Column:
    """struct(given, surname): the last word is the surname."""
    w = F.split(normalised_space(name), " ")
    return F.struct(F.array_join(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), " ").alias("given"), F.element_at(w, -1).alias("surname"))


def authors(authorships: Column | str) -> Column:
    """array<struct<author struct<display_name, orcid>, raw_affiliation_strings, institutions array<struct<display_name>>>> as (given, surname, orcid, affs).

    Those without a name go. Affiliations are those printed, or else the institutions' names.
    """
    def one(a: Column) -> Column:
        who = person(F.trim(a["author"]["display_name"]))
        some = F.filter(F.coalesce(a["raw_affiliation_strings"], F.array().cast("array<string>")), lambda x: x.isNotNull() & (F.trim(x) != ""))
        houses = F.filter(F.transform(F.coalesce(a["institutions"], F.array().cast("array<struct<display_name:string>>")), lambda i: i["display_name"]), lambda x: x.isNotNull() & (x != ""))
        return F.struct(who["given"].alias("given"), who["surname"].alias("surname"), F.coalesce(a["author"]["orcid"], F.lit("")).alias("orcid"), F.when(F.size(some) > 0, some).otherwise(houses).alias("affs"))
    named = F.filter(_c(authorships), lambda a: F.coalesce(F.trim(a["author"]["display_name"]), F.lit("")) != "")
    return F.coalesce(F.transform(named, one), F.array().cast("array<struct<given:string,surname:string,orcid:string,affs:array<string>>>"))


def split_list(text: Column | str) -> Column:
    """Parts at commas outside of double quotes; quotes go, an empty last part too."""
    parts = F.split(F.regexp_replace(_c(text), r',(?=(?:[^"]*"[^"]*")*[^"]*$)', "\u0001"), "\u0001")
    parts = F.transform(parts, lambda x: F.replace(x, F.lit('"'), F.lit("")))
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def plan_items(plan: Column | str) -> Column:
    """``Name:N,Name:N`` as array of struct(name, n); the last colon divides."""
    return F.transform(F.filter(F.split(_c(plan), ","), lambda x: F.trim(x) != ""), lambda x: F.struct(F.trim(F.regexp_extract(x, r"^(.*):\s*\d+\s*$", 1)).alias("name"), F.regexp_extract(x, r":\s*(\d+)\s*$", 1).try_cast("int").alias("n")))


def xml_escaped(text: Column | str) -> Column:
    out = F.replace(_c(text), F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def title(xml: Column | str) -> Column:
    """The text of the first article title, 300 characters at most; null without one."""
    inner = F.regexp_extract(_c(xml), r"(?s)<article-title[^>]*>(.*?)</article-title>", 1)
    return F.when(_c(xml).rlike(r"(?s)<article-title[^>]*>.*?</article-title>"), F.substring(F.trim(F.regexp_replace(inner, "<[^>]+>", "")), 1, 300))


def citation_number(key: Column | str) -> Column:
    """Trailing digits without leading zeros, else the key itself."""
    digits = F.regexp_extract(_c(key), r"(\d+)\s*$", 1)
    return F.coalesce(F.nullif(F.regexp_replace(digits, r"^0+(?=\d)", ""), F.lit("")), _c(key))


def hash16(data: Column | str) -> Column:
    """16 hex characters of SHA-256; ``missing`` for null."""
    return F.coalesce(F.substring(F.sha2(_c(data), 256), 1, 16), F.lit("missing"))


def licence_verdict(xml: Column | str) -> Column:
    """struct(ok, uri, detail) of the licence that a document declares.

    A licence address in the permissions decides, else one anywhere; without one, the wording of the
    permissions, where a restrictive word outweighs a permissive one. What isn't clear fails.
    """
    x = _c(xml)
    block = F.regexp_extract(x, r"(?s)<permissions>.*?</permissions>", 0)
    uri_in = lambda t: F.nullif(F.regexp_extract(t, f"(?i){CC_URI}", 0), F.lit(""))
    uri = F.coalesce(uri_in(block), uri_in(x))
    flavour = F.lower(F.regexp_extract(uri, f"(?i){CC_URI}", 1))
    low = F.lower(block)
    ok = F.when(x.isNull(), False).when(uri.isNotNull(), flavour == "by").when((block == "") | low.rlike(RESTRICTIVE), False).otherwise(low.rlike(PROSE_BY))
    detail = (
        F.when(x.isNull(), "unreadable article.xml").when(uri.isNotNull() & (flavour == "by"), "CC-BY (uri)")
        .when(uri.isNotNull(), F.concat(F.lit("CC-"), F.upper(flavour), F.lit(" is not CC-BY"))).when(block == "", "no licence in article.xml")
        .when(low.rlike(RESTRICTIVE), "restrictive Creative Commons terms (not CC-BY)").when(low.rlike(PROSE_BY), "CC-BY (prose)").otherwise("no recognisable CC-BY licence"))
    return F.struct(ok.alias("ok"), uri.alias("uri"), detail.alias("detail"))


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


def normal_form(text: Column | str) -> Column:
    """Ligatures and Unicode compatibility forms replaced. A text in plain ASCII has none: it stays in the JVM, and Python gets a null for it."""
    t = _c(text)
    wide = F.rlike(t, F.lit("[^\\x00-\\x7F]"))
    spelled = t
    for k, v in LIGATURES.items():
        spelled = F.replace(spelled, F.lit(k), F.lit(v))
    return F.when(wide, nfkc(F.when(wide, spelled))).otherwise(t)


def tokens(text: Column | str) -> Column:
    """Runs of a-z0-9 of the lower-cased text, words hyphenated over a line end joined.

    The pattern with Unicode word characters is tried only on texts that have a hyphen before a line
    end; other characters become one space each run, which splits in half the time of extraction.
    """
    low = F.lower(_c(text))
    joined = F.when(low.rlike(r"-\s*\n"), F.regexp_replace(low, r"(?U)(\w)-\s*\n\s*(\w)", "$1$2")).otherwise(low)
    words = F.trim(F.regexp_replace(joined, "[^a-z0-9]+", " "))
    return F.when(words == "", F.array().cast("array<string>")).otherwise(F.split(words, " "))


def with_letter(toks: Column | str) -> Column:
    return F.filter(_c(toks), lambda t: t.rlike("[a-z]"))


def numerals(toks: Column | str) -> Column:
    """Distinct tokens of at least two characters with a digit."""
    return F.array_distinct(F.filter(_c(toks), lambda t: t.rlike("[0-9]") & (F.length(t) >= 2)))


def shingles(toks: Column | str, n: int = 5, hashed: bool = False) -> Column:
    """Every n tokens in a row, in order; none of fewer than n. ``hashed``: as 64-bit numbers, for sets that are only counted.

    The array is shifted and zipped, so that it is never named inside a lambda: where a filter is
    pushed down, Catalyst puts what makes the array in place of its name, and would run it per element.
    """
    t = _c(toks)
    m = F.greatest(F.size(t) - (n - 1), F.lit(0))
    zipped = F.arrays_zip(*[F.slice(t, i + 1, m).alias(f"t{i}") for i in range(n)])
    return F.transform(zipped, lambda z: F.xxhash64(*[z.getField(f"t{i}") for i in range(n)]) if hashed else F.concat_ws(" ", *[z.getField(f"t{i}") for i in range(n)]))


def caption_key(text: Column | str) -> Column:
    """A caption's letters and digits, lower-cased."""
    return F.regexp_replace(F.lower(_c(text)), "[^a-z0-9]+", "")


def captions_aligned(a: Column | str, b: Column | str) -> Column:
    """Whether any 8 characters in a row of the first 80 of one caption's key are in the other's."""
    keys = F.array(F.struct(F.substring(caption_key(a), 1, 80).alias("x"), caption_key(b).alias("y")))  # made once: named in a lambda, they would be made for every place
    found = F.exists(keys, lambda k: F.exists(F.sequence(F.lit(1), F.length(k["x"]) - 7), lambda i: F.contains(k["y"], F.substr(k["x"], i, F.lit(8)))))
    return F.when(F.length(F.substring(caption_key(a), 1, 80)) >= 8, found).otherwise(F.lit(False))
