"""Benchmark decontamination by template windows, with built-in functions only.

Numbers, units after numbers and names become typed placeholders, so a question keeps its template when its parameters
change.  A capital at the start of a sentence may be a name or not, so its windows are read both ways.  Template windows of documents are hash-joined with those of the
benchmark; a document that holds enough of an item's windows is a leak if the values in the slots
fit together: each value of the item stands for one value of the document.  Windows whose raw words are equal always count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.rows import texts
from tidemill.operators.skew import small_side
from tidemill.session import materialize

#: words of a window, and the share of an item's windows that makes a leak
WIDTH = 5
SIMILARITY = 0.8
#: literal words that an item's template holds at least, or only its own words match it
LITERALS = 2

# fixed values: units that are recognised behind a number, in English, German, French and Spanish
UNITS = (
    "km m cm mm miles mile ft feet inches inch kg g mg lb lbs oz tons l ml litres liters hours hour minutes minute seconds second "
    "days day weeks week months month years year dollars dollar cents euros euro pounds percent degrees mph kmh "
    "stunden stunde minuten sekunden sekunde tagen tage tag wochen woche monaten monate monat jahren jahre jahr meilen meile meter metern "
    "kilometer kilometern zentimeter millimeter gramm kilogramm kilo pfund tonnen tonne liter cent franken prozent grad "
    "heures heure secondes seconde jours jour semaines semaine mois ans an années année mètres mètre kilomètres kilomètre centimètres centimètre "
    "grammes gramme kilogrammes kilogramme kilos tonnes litre centimes centime francs franc pourcent degrés degré "
    "horas hora minutos minuto segundos segundo días día semanas semana meses mes años año metros metro kilómetros kilómetro centímetros centímetro "
    "gramos gramo kilogramos kilogramo toneladas tonelada litros litro dólares dólar céntimos céntimo pesos peso grados grado"
).split()

NUMBER, UNIT, NAME, FIRST = "\u0001", "\u0002", "\u0003", "\u0004"
AFTER = "\u0005"  # words that begin with a mark sort before it
_NUMBER_UNIT = rf"([0-9]++)(\s*+)((?iu:{'|'.join(dict.fromkeys(UNITS))}))(?![\p{{L}}\p{{N}}])"
# the first capital of a text or behind the end of a sentence; all others that begin a word
_FIRST = r"(^|[.!?:\u2026][^\p{L}\p{N}\s]{0,3}\s)([^\p{L}\p{N}]*)(?=\p{Lu})"
_NAME = rf"(?<![\p{{L}}\p{{N}}{NUMBER}-{FIRST}])(?=\p{{Lu}})"


def marked(text: Column) -> Column:
    """Text whose numbers, units and names carry the mark of their type, as words of their own."""
    joined = F.regexp_replace(text, r"(?<=[0-9])[.,](?=[0-9])", "")
    counted = F.regexp_replace(joined, _NUMBER_UNIT, f" {NUMBER}$1 {UNIT}$3 ")
    counted = F.regexp_replace(counted, rf"(?<![0-9{NUMBER}])([0-9]+)", f" {NUMBER}$1 ")
    named = F.regexp_replace(F.when(text.rlike("[0-9]"), counted).otherwise(text), _FIRST, f"$1$2{FIRST}")
    return F.regexp_replace(named, _NAME, NAME)


def raw_words(text: Column) -> Column:
    """Lower-case words; those that fill a slot begin with its mark."""
    return _words(marked(_plain(text)))


def _value(word: Column) -> Column:
    """The word without its mark."""
    return F.when(word < AFTER, F.substring(word, 2, 1 << 30)).otherwise(word)


def _slot(word: Column) -> Column:
    """The word, or the bare mark of its slot; a sentence's first capital is a name."""
    return F.when(word >= AFTER, word).when(word >= NAME, F.lit(NAME)).otherwise(F.substring(word, 1, 1))


def _inner_slot(word: Column) -> Column:
    """The same, but a sentence's first capital is a word like any other."""
    return F.when(word >= AFTER, word).when(word >= FIRST, F.substring(word, 2, 1 << 30)).otherwise(F.substring(word, 1, 1))


#: a window matches if any reading of it does: its words, or one of its templates
READINGS = {"plain": _value, "template": _slot, "inner": _inner_slot}


def _read(raw: Column) -> Column:
    """Hashes of every word, by reading."""
    return F.transform(raw, lambda w: F.struct(*[F.xxhash64(read(w)).alias(name) for name, read in READINGS.items()]))


def _plain(text: Column) -> Column:
    return F.translate(text, NUMBER + UNIT + NAME + FIRST, "    ")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), rf"[^\p{{L}}\p{{N}}{NUMBER}-{FIRST}]+"), "")


def _windows(words: str, width: int) -> Column:
    """Hashes of every run of ``width`` words, by reading; none where there are fewer."""
    last = F.size(words) - (width - 1)  # words are named twice, so they are not worked out anew for every run
    runs = F.transform(F.sequence(F.lit(1), last), lambda i: F.slice(words, i, width))
    hashes = F.transform(runs, lambda run: F.struct(*[F.xxhash64(run[name]).alias(name) for name in READINGS]))
    return F.when(last > 0, hashes).otherwise(F.array().cast(f"array<struct<{','.join(f'{name}:bigint' for name in READINGS)}>>"))


def _placed_windows(words: str, width: int) -> Column:
    """The same with their place."""
    return F.transform(_windows(words, width), lambda read, at: F.struct(at.alias("place"), read.alias("read")))


def _items(benchmark: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(item_id, raw, words, width, item); texts without words are left out."""
    rows = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.select("item_id", raw_words(F.col("text")).alias("raw")).distinct().withColumn("words", _read(F.col("raw")))
    rows = rows.filter(F.size("raw") > 0).withColumn("width", F.least(F.size("raw"), F.lit(width)))
    return rows.withColumn("item", F.xxhash64("item_id", "raw"))


def _item_windows(items: DataFrame, width: int) -> DataFrame:
    """(item, width, at, window, bare, hash): the windows of each item, named by their words, and the hashes that match them.

    A template without a literal word, or of an item with too few of them, matches nothing by itself; a window
    that has no other is ``bare``.
    """
    at = [F.when(F.col("width") == w, _windows("words", w)) for w in range(1, width + 1)]
    rows = items.select("item", "width", "raw", F.posexplode(F.coalesce(*at)).alias("at", "read"))
    run = F.slice("raw", F.col("at") + 1, F.col("width"))

    def literal(words: Column, read) -> Column:
        return F.size(F.array_distinct(F.filter(words, lambda w: read(w) >= AFTER)))

    templates = {name: read for name, read in READINGS.items() if name != "plain"}
    keys = [F.when((literal(run, read) > 0) & (literal(F.col("raw"), read) >= LITERALS), F.col(f"read.{name}")) for name, read in templates.items()]
    keys = F.array_compact(F.array(*keys))
    return rows.select(
        "item", "width", "at", F.col("read.plain").alias("window"), (F.size(keys) == 0).alias("bare"),
        F.explode(F.array_distinct(F.concat(F.array("read.plain"), keys))).alias("hash"),
    )


def _distinct(read: str) -> Column:
    return F.array_distinct(F.array(*[F.col(f"{read}.{name}") for name in READINGS]))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY,
) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, n_found, similarity): one row per text of an id and item that it leaks.

    ``n_windows`` counts the item's windows of distinct words, ``n_found`` those that the document holds word by word
    or as a template with consistent slots.  Items shorter than a window are one window of their own length.
    Windows of slots alone count if they are equal, or as templates beside a window with literal words; items with fewer than
    ``LITERALS`` literal words are matched by their words alone.  NULL or empty
    texts leak nothing and are leaked by nobody; repeated rows give one row; a NULL id is kept; empty tables give no rows.
    Matches are counted per document and window before they are shuffled.
    """
    items = materialize(_items(benchmark, item_id_col, item_text_col, width))
    stored = materialize(_item_windows(items, width))
    sizes = stored.groupBy("item").agg(F.countDistinct("window").alias("n_windows"), F.countDistinct(F.when(F.col("bare"), F.col("window"))).alias("n_bare"))
    widths = sorted(r.width for r in stored.select("width").distinct().collect())  # at most ``width`` numbers
    plain = texts(docs, id_col, text_col).select("doc_id", text_hash(F.col("text")).alias("text_hash"), "text")
    worded = plain.select("doc_id", "text_hash", _read(raw_words(F.col("text"))).alias("words"))
    found = None
    if widths:  # windows of all widths from one reading of a text
        if len(widths) == 1:
            placed = worded.select("doc_id", "text_hash", F.posexplode(_windows("words", widths[0])).alias("place", "read"))
        else:
            placed = worded.select("doc_id", "text_hash", F.explode(F.concat(*[_placed_windows("words", w) for w in widths])).alias("x"))
            placed = placed.select("doc_id", "text_hash", "x.*")
        # a hash is that of a run of words and so of its width, too
        windows = placed.select("doc_id", "text_hash", "place", F.explode(_distinct("read")).alias("hash"))
        keys = stored.select("hash", "item", "at", "window", "bare")
        found = windows.join(small_side(keys) or keys, "hash").select("doc_id", "text_hash", "item", "window", "bare", "at", "place", (F.col("hash") == F.col("window")).alias("exact"))
    if found is None:
        found = stored.select(F.lit(None).cast(docs.schema[id_col].dataType).alias("doc_id"), F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).alias("text_hash"), "item", "window", "bare", "at", F.lit(0).alias("place"), F.lit(True).alias("exact"))
    pair = ["doc_id", "text_hash", "item"]
    found = materialize(found)
    counted = found.groupBy(*pair, "window").agg(F.max("exact").alias("exact"), F.min("bare").alias("bare")).groupBy(*pair).agg(
        F.count(F.lit(1)).alias("n_found"), F.count_if("exact").alias("n_exact"), F.count_if(~F.col("bare")).alias("n_rich")
    )
    enough, might = F.col("n_found") >= similarity * F.col("n_windows"), F.col("n_rich") + F.col("n_bare") >= similarity * F.col("n_windows")
    near = materialize(counted.join(sizes, "item").filter(enough | ((F.col("n_rich") > 0) & might)))
    doubt = (F.col("n_exact") < F.col("n_found")) | ((F.col("n_bare") > 0) & (F.col("n_found") < F.col("n_windows")))
    columns = [*pair, "n_windows", "n_found"]
    doubtful, sure = materialize(near.filter(doubt).select(*columns)), near.filter(~doubt).select(*columns)
    if not doubtful.isEmpty():
        sure = sure.unionByName(_consistent(plain, items, stored, doubtful, found, similarity))
    named = sure.join(items.select("item", "item_id"), "item")
    rows = named.groupBy("doc_id", "text_hash", "item_id").agg(F.max(F.struct("n_found", "n_windows")).alias("m"))
    return rows.select("doc_id", "text_hash", "item_id", "m.n_windows", "m.n_found", (F.col("m.n_found") / F.col("m.n_windows")).alias("similarity"))


def text_hash(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))


def _consistent(plain: DataFrame, items: DataFrame, stored: DataFrame, doubtful: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """The doubtful pairs that remain when windows over a contradicting slot are left out.

    Along one alignment a value of the item stands for the value of the document that it meets at most places; of
    equally frequent ones for itself, else for the first.  Only windows that cover another value are left out.
    Windows of slots alone are matched here, along the alignments of windows with literal words.
    """
    pair, aligned = ["text_hash", "item"], ["text_hash", "item", "shift"]
    hits = found.join(doubtful.select(*pair).distinct(), pair, "left_semi").groupBy(*pair, "window", "bare", "at", "place").agg(F.max("exact").alias("exact"))
    lines = hits.filter("NOT bare").select(*pair, (F.col("place") - F.col("at")).alias("shift")).distinct()
    bare = lines.join(stored.filter("bare").select("item", "window", "bare", "at").distinct(), "item").withColumn("place", F.col("shift") + F.col("at"))
    bare = bare.filter("place >= 0").withColumn("exact", F.lit(False)).select(*hits.columns)
    hits = hits.unionByName(bare)
    words = plain.join(doubtful.select("text_hash").distinct(), "text_hash", "left_semi").groupBy("text_hash").agg(F.first("text").alias("text"))
    words = words.select("text_hash", raw_words(F.col("text")).alias("theirs"))
    both = hits.join(words, "text_hash").join(items.select("item", "raw", "width"), "item").select(
        *pair, (F.col("place") - F.col("at")).alias("shift"), "window", "at", "exact",
        F.slice("raw", F.col("at") + 1, F.col("width")).alias("ours"), F.slice("theirs", F.col("place") + 1, F.col("width")).alias("other"),
    )
    alike = [F.transform("ours", read) == F.transform("other", read) for read in READINGS.values()]
    both = materialize(both.filter(F.col("exact") | alike[0] | alike[1] | alike[2]).withColumn("exact", F.col("exact") | alike[0]))
    steps = both.select(*aligned, "at", "exact", F.posexplode(F.arrays_zip("ours", "other")).alias("k", "w"))
    steps = steps.filter(F.col("w.ours").rlike(f"^[{NUMBER}-{FIRST}]")).select(
        *aligned, "at", "exact", (F.col("at") + F.col("k")).alias("spot"), F.translate("w.ours", FIRST, NAME).alias("ours"), _value(F.col("w.other")).alias("other")
    )
    votes = steps.groupBy(*aligned, "ours", "other").agg(F.countDistinct("spot").alias("n"), F.min("spot").alias("first"))
    rank = F.struct("n", (_value(F.col("ours")) == F.col("other")).alias("same"), -F.col("first"))
    means = votes.groupBy(*aligned, "ours").agg(F.max_by("other", rank).alias("means"))
    wrong = steps.filter(~F.col("exact")).join(means, [*aligned, "ours"]).filter(F.col("other") != F.col("means"))
    kept = both.join(wrong.select(*aligned, "at").distinct(), [*aligned, "at"], "left_anti")
    again = doubtful.drop("n_found").join(kept.groupBy(*pair).agg(F.countDistinct("window").alias("n_found")), pair)
    return again.filter(F.col("n_found") >= similarity * F.col("n_windows")).select(*doubtful.columns)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose text leaks no item, with all their columns, whatever those are called."""
    leaked = find_leaks(docs, benchmark, text_col=text_col, **settings).select("text_hash").distinct()
    rows = docs.select(F.struct("*").alias("row"), text_hash(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("text_hash"))
    return rows.join(materialize(leaked), "text_hash", "left_anti").select("row.*")
