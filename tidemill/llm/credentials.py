"""Secret scan with corpus-wide ownership, with built-in functions only.

Patterns propose candidates; their hashes are counted over distinct repositories and owners of the whole
corpus.  What many owners hold is a copied example, what one owner holds is a live-looking credential.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import materialize

# fixed values: the base kinds in their order.  A dropped "access" or "hex" match cannot hide a longer
# one, so their least lengths stand in the pattern; an assignment's value is judged after matching.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8

#: kinds that count as secrets only while they look owned, unless examples are asked for too: private keys, signed tokens, vendor prefixes, logins in URLs
ADDED = {
    "pem": r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}-----END [A-Z ]{0,20}PRIVATE KEY-----",
    "jwt": r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
    "vendor": r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{20,}|[sr]k_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})",
    "login": r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{6,64}@",
}
KINDS = ["assign", "access", "hex", *ADDED]
#: a hash that more owners hold is a copied example
MOST_OWNERS = 1
#: with ``examples``: a value that no more owners, or no more repositories, hold in differing texts is live
HANDFUL = 5

# where no text matches this, no pattern does
_ANY = r"""(?i:passw(?:or)?d|secret|token|api_?key)["']?\x20*[:=]|AKIA|[0-9a-f]{32}|PRIVATE KEY-----|eyJ|gh[pousr]_|glpat-|xox[abprs]-|[sr]k_live_|AIza|://"""

SPANS = "array<struct<start:bigint,rank:int,stop:bigint,kind:string,value:string>>"


#: an array is summed up, and a text cut up, so many elements or characters at a time
STRETCH = 256
CHUNK = 4_096


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once however often it is named, also in lambdas."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, zero: Column, step) -> Column:
    """For every element what ``step`` (associative, ``zero`` changes nothing) makes of it and all before it.

    Appending to an array copies it, so long arrays are done in stretches whose totals are then put in front of them.
    """

    def plain(xs: Column) -> Column:
        grown = F.aggregate(xs, F.array(zero), lambda done, x: F.concat(done, F.array(step(F.element_at(done, -1), x))))
        return F.slice(grown, F.lit(2), F.greatest(F.size(xs), F.lit(0)))

    def long(xs: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / STRETCH).cast("int"))
        return _bound(F.transform(places, lambda i: plain(F.slice(xs, i * STRETCH + 1, F.lit(STRETCH)))), joined)

    def joined(parts: Column) -> Column:
        before = _bound(F.transform(parts, lambda part: F.element_at(part, -1)), lambda ends: F.concat(F.array(zero), plain(ends)))
        return F.flatten(F.zip_with(parts, F.slice(before, F.lit(1), F.size(parts)), lambda part, past: F.transform(part, lambda x: step(past, x))))

    return _bound(values, lambda xs: F.when(F.size(xs) <= STRETCH, plain(xs)).otherwise(long(xs)))


def _found(text: Column, kind: str, pattern: str, group: int = 0) -> Column:
    """Spans of a pattern in code points, from the texts between its matches."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    steps = F.zip_with(gaps, whole, lambda g, m: (F.length(g) + F.length(m)).cast("long"))
    ends = _running(steps, F.lit(0).cast("long"), lambda a, b: a + b)
    placed = F.zip_with(whole, ends, lambda m, e: F.struct(m.alias("m"), e.alias("e")))
    spans = F.zip_with(
        placed, value,
        lambda p, v: F.struct(
            (p["e"] - F.length(p["m"])).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), p["e"].alias("stop"),
            F.lit(kind).alias("kind"), v.alias("value"),
        ),
    )
    least = LEAST_VALUE if kind == "assign" else 0
    kept = F.filter(spans, lambda s: F.length(s["value"]) >= least) if least else spans
    return F.when(text.rlike(pattern), kept).otherwise(F.array().cast(SPANS))


def candidates(text: Column) -> Column:
    """All candidate spans of a text by start, then kind."""
    base = [_found(text, "assign", ASSIGN, 2), _found(text, "access", ACCESS), _found(text, "hex", HEX)]
    added = [_found(text, kind, pattern) for kind, pattern in ADDED.items()]
    return F.when(text.rlike(_ANY), F.array_sort(F.concat(*base, *added))).otherwise(F.array().cast(SPANS))


def _hashed(spans: Column) -> Column:
    """Spans with their value's digest in place of the value."""
    kept = ("start", "rank", "stop", "kind")
    return F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in kept], F.sha2(s["value"], 256).alias("hash")))


def ownership(hits: DataFrame) -> DataFrame:
    """(hash, n_rows, n_repos, n_owners) of candidates (hash, repo, owner).

    Counted per (hash, repository, owner) first, so a value that stands in a third of all documents
    is a few rows when it is shuffled; NULL repositories and owners count as one each.
    """
    known = hits.select("hash", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("repo", "owner")])
    rows = known.groupBy("hash", "repo", "owner").agg(F.count(F.lit(1)).alias("n"))
    repos = rows.groupBy("hash", "repo").agg(F.sum("n").alias("n")).groupBy("hash").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_repos"))
    owners = rows.select("hash", "owner").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"))
    return repos.join(owners, "hash")


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None, owner: Column | None = None,
    most_owners: int = MOST_OWNERS, examples: bool = False,
) -> DataFrame:
    """(doc_id, spans): one row per input row; a span is (start, rank, stop, kind, hash, n_repos, n_owners, live).

    Base kinds are always spans; the other kinds are spans if they are live, that is if at most
    ``most_owners`` owners hold the value.  With ``examples`` every candidate is a span and ownership sets its class alone:
    live if at most ``most_owners`` owners or as many repositories hold the value, where copies of one text count once.  A NULL text is empty and has no spans; repeated rows are rows of their own;
    NULL ids, repositories and owners are allowed; an empty table gives no rows.
    """
    blank = F.lit("")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), (blank if repo is None else repo).alias("repo"), (blank if owner is None else owner).alias("owner"),
        F.coalesce(F.col(f"`{text_col}`"), blank).alias("text"),
    )
    rows = materialize(rows.select("doc_id", "repo", "owner", F.xxhash64("text").alias("copy"), _hashed(candidates(F.col("text"))).alias("found")))
    rows = rows.withColumn("row", F.monotonically_increasing_id())  # fixed, since it numbers stored rows
    judged = _judged(rows, most_owners, examples)
    return rows.join(judged, "row", "left").select("doc_id", F.coalesce("spans", F.array().cast(judged.schema["spans"].dataType)).alias("spans"))


def _judged(rows: DataFrame, most_owners: int, examples: bool) -> DataFrame:
    """(row, spans) of the rows with candidates (row, repo, owner, copy, found); ``copy`` is a hash of the text."""
    hits = rows.select("row", "repo", "owner", "copy", F.explode("found").alias("s")).select("row", "repo", "owner", "copy", "s.*")
    held = hits
    if examples:  # one holder of each text, any of them
        holder = F.struct("repo", "owner")
        held = hits.groupBy("hash", "copy").agg(F.min_by(holder, F.struct(F.xxhash64("copy", holder), holder)).alias("h")).select("hash", "h.*")
    known = materialize(ownership(held))
    live = F.col("n_owners") <= most_owners
    told = hits.drop("repo", "owner", "copy").join(known.drop("n_rows"), "hash")
    told = told.withColumn("live", (live | (F.col("n_repos") <= most_owners)) if examples else live)
    if not examples:
        told = told.filter(F.col("live") | (F.col("rank") < 3))
    span = F.struct("start", "rank", "stop", "kind", "hash", "n_repos", "n_owners", "live")
    return told.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def redact_secrets(
    docs: DataFrame, text_col: str = "text", repo: Column | None = None, owner: Column | None = None, length_col: str | None = None,
    most_owners: int = MOST_OWNERS, examples: bool = False,
) -> DataFrame:
    """``docs`` with every span replaced in its text: live ones by ``[SECRET]``, copied examples by ``[EXAMPLE]``.

    Rows without candidates are passed on where they are read, others are numbered and joined with their spans.
    Overlapping spans are one, live if one of them is.  All columns are kept; ``length_col`` is set to the new
    text's length in changed rows.  A NULL text stays NULL.  ``examples`` is that of ``scan_secrets``.
    """
    blank = F.lit("")
    text = F.col("text")
    has = F.coalesce(F.col(f"`{text_col}`").rlike(_ANY), F.lit(False))
    rows = docs.filter(has).select(
        F.struct("*").alias("input"), F.col(f"`{text_col}`").alias("text"),
        (blank if repo is None else repo).alias("repo"), (blank if owner is None else owner).alias("owner"),
    )
    rows = materialize(rows.withColumn("copy", F.xxhash64("text")).withColumn("found", _hashed(candidates(text))))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    changed = rows.select("row", "input", "text").join(_judged(rows, most_owners, examples), "row", "left")
    new = F.when(F.size("spans") > 0, _replaced(text, F.col("spans"))).otherwise(text)
    changed = changed.withColumn("new", new)
    columns = []
    for field in docs.columns:
        old = F.col(f"input.`{field}`")
        if field == text_col:
            old = F.col("new")
        elif field == length_col:
            old = F.when(F.col("new") == text, old).otherwise(F.length("new").cast(docs.schema[field].dataType))
        columns.append(old.alias(field))
    return docs.filter(~has).union(changed.select(*columns))


def _replaced(text: Column, spans: Column) -> Column:
    """The text with merged spans replaced; spans come in the order of their starts."""
    reaches = _running(F.transform(spans, lambda s: s["stop"]), F.lit(0).cast("long"), lambda a, b: F.greatest(a, b))

    def merged(at: Column) -> Column:
        """(start, stop, live) of spans that overlap or of one alone; ``at`` has the spans and how far they and those before them reach."""
        own, reach = at["spans"], at["reaches"]
        begun = F.filter(F.sequence(F.lit(1), F.size(own)), lambda i: (i == 1) | (own[i - 1]["start"] >= reach[F.greatest(i - 2, F.lit(0))]))
        ends = lambda first: F.concat(F.slice(first, F.lit(2), F.size(first)), F.array(F.size(own) + 1))
        group = lambda i, j: F.struct(
            own[i - 1]["start"].alias("start"), reach[j - 2].alias("stop"), F.exists(F.slice(own, i, j - i), lambda s: s["live"]).alias("live")
        )
        return _bound(begun, lambda first: F.zip_with(first, ends(first), group))

    def said(live: Column) -> Column:
        return F.when(live, F.lit("[SECRET]")).otherwise(F.lit("[EXAMPLE]"))

    def cut(at: Column) -> Column:
        """The text between and behind the merged spans, from its chunks: a place far into a text is not looked for from its beginning."""
        chunks, found = at["chunks"], at["merged"]

        def between(start: Column, stop: Column) -> Column:
            places = F.sequence(F.floor(start / CHUNK).cast("int"), F.floor(stop / CHUNK).cast("int"))
            inside = lambda i: F.substr(
                F.coalesce(F.get(chunks, i), F.lit("")), (F.greatest(start - i * CHUNK, F.lit(0)) + 1).cast("int"),
                (stop - F.greatest(start, (i * CHUNK).cast("long"))).cast("int"),
            )
            return F.array_join(F.transform(places, inside), "")

        starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(found, lambda s: s["stop"]))
        pieces = F.zip_with(F.slice(starts, F.lit(1), F.size(found)), found, lambda before, s: F.concat(between(before, s["start"]), said(s["live"])))
        return F.concat(F.array_join(pieces, ""), between(F.element_at(found, -1)["stop"], at["length"]))

    whole = _bound(F.struct(spans.alias("spans"), reaches.alias("reaches")), merged)
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    return _bound(F.struct(chunks.alias("chunks"), whole.alias("merged"), F.length(text).cast("long").alias("length")), cut)
