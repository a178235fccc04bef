"""Benchmark decontamination by canonical templates, with Spark's own functions only.

Names, numbers and units of a text become typed placeholders; what is left, a
template, is the same for a question and its re-parameterised copies. Windows
of template tokens are hashed and joined with those of the benchmark. A capitalised word that
begins a sentence may be a name or a plain word: windows with one are hashed in both readings, and
either may meet.

Where windows hold placeholders, the values must be consistent: a value of the item stands for one value
of the document over all alignments that count. An alignment that gives one value two meanings does not
count; of alignments that contradict each other the one with the most windows leads (the first among
equals), and those that differ from it in a value do not count. A document is contaminated by an item if
at least ``COVERAGE`` of the item's usable windows occur in it so. Windows of fewer than ``LITERALS`` words
beside placeholders tell nothing by themselves and are not used.

Items of which that leaves less than ``COVERAGE`` of the windows, and items of fewer
tokens than a window, are whole: their whole template must occur, in one of both readings and with consistent
values. One window, the one with the most words, finds the places to look at. With
fewer than ``LITERALS`` words in the whole item its template tells nothing either, and
the values must be the same; if it has fewer tokens than that as well ('Why?'), it
must be all of the document, as nearly every text holds such words.

Defined results: null and empty texts match nothing, nor do items without a token;
a letter of a script written without blanks is a token; repeated items are each reported,
repeated documents once, and a null id like any other; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import stored, unused

WINDOW = 5
LITERALS = 3
COVERAGE = 0.5

#: Marks before a name, a number, a unit and a capitalised word that begins a sentence; END closes each of them.
NAME_MARK, NUMBER_MARK, UNIT_MARK, INITIAL_MARK, END = "\u0001", "\u0002", "\u0003", "\u0004", "\u0005"
#: Words that are units if they follow a number (fixed values).
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "ft", "feet", "foot", "yard", "yards", "mile", "miles", "meter", "meters", "metre", "metres",
    "kilometer", "kilometers", "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms", "ton", "tons", "oz", "ounce", "ounces", "lb", "lbs",
    "pound", "pounds", "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "cup", "cups", "s", "sec", "second", "seconds",
    "min", "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "mph", "kmh", "hz",
    "khz", "mhz", "ghz", "w", "kw", "v", "a", "j", "kj", "n", "pa", "k", "dollar", "dollars", "cent", "cents", "euro", "euros", "usd", "eur",
    "percent", "degree", "degrees",
)
_REST = r"[\p{L}'-]*+"
# Repeated groups are possessive, as nothing after them could give a part back: Java goes through others by recursion, and a
# few thousand numbers or names in a row end an executor with its stack.
# Capitalised words; those that follow each other are one name where the first one does not begin a sentence, that is,
# follows a small letter, a comma or a semicolon and one blank.
NAME = rf"\p{{Lu}}(?<![\p{{L}}{UNIT_MARK}]\p{{Lu}})(?:(?<=[\p{{Ll}},;] \p{{Lu}}){_REST}(?: \p{{Lu}}{_REST})*+|{_REST})"
INITIAL = rf"(?<![\p{{Ll}}{END},;] ){NAME_MARK}"
NUMBER = r"[0-9]++(?:[.,:/][0-9]++)*+"
UNIT = rf"(?<={END})( ?)({'|'.join(UNITS)}|[%€$£°])(?!\p{{L}})"
# Letters of scripts that put no blanks between words; each is a token.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
TOKEN = rf"[{NAME_MARK}-{INITIAL_MARK}][^{END}]*+{END}|(?:[a-z]++|[\p{{L}}&&[^{UNSPACED}]])++|[{UNSPACED}]"


def tokens(text: Column) -> Column:
    """Tokens of a text in lower case; placeholders keep their value between their mark and END."""
    marks = NAME_MARK + NUMBER_MARK + UNIT_MARK + INITIAL_MARK + END
    t = F.translate(text, marks, " " * len(marks))
    t = F.regexp_replace(t, NUMBER, f"{NUMBER_MARK}$0{END}")
    t = F.regexp_replace(t, rf"(?i){UNIT}", f"$1{UNIT_MARK}$2{END}")
    t = F.regexp_replace(t, NAME, f"{NAME_MARK}$0{END}")
    t = F.regexp_replace(t, INITIAL, INITIAL_MARK)
    return F.regexp_extract_all(F.lower(t), F.lit(TOKEN), F.lit(0))


def said(token: Column) -> Column:
    """A token without its marks."""
    return F.when(token < END, F.substring(token, F.lit(2), F.length(token) - 2)).otherwise(token)


def templates(found: Column) -> tuple[Column, Column]:
    """A hash for each token: of the word, or of the placeholder's type alone. First with words that begin a sentence as words, then as names."""
    as_word = F.transform(found, lambda t: F.xxhash64(F.when(t >= END, t).when(t >= INITIAL_MARK, said(t)).otherwise(F.substring(t, 1, 1))))
    as_name = F.transform(found, lambda t: F.xxhash64(F.when(t >= END, t).when(t >= INITIAL_MARK, NAME_MARK).otherwise(F.substring(t, 1, 1))))
    return as_word, as_name


def windows(rows: DataFrame, widths: list[int]) -> DataFrame:
    """``rows`` (with ``words`` and ``names``, the two templates) as one row per different window: the other columns, ``pos`` and ``window``.

    ``widths`` are those of windows; the ones below ``LITERALS`` are only taken where they are the whole text.
    """
    n, least, most = F.size("words"), min(widths), max(widths)
    starts = F.when(n < LITERALS, 1).otherwise(F.greatest(F.lit(0), n - (max(least, LITERALS) - 1))) if least < WINDOW else F.greatest(F.lit(0), n - (WINDOW - 1))
    shifted = [F.slice(c, F.lit(k + 1), starts).alias(f"{c[0]}{k}") for c in ("words", "names") for k in range(most)]
    others = [c for c in rows.columns if c not in ("words", "names")]
    out = rows.select(*others, n.alias("n"), F.posexplode(F.arrays_zip(*shifted)).alias("pos", "w"))

    def hashed(c: str, width: int) -> Column:
        whole = F.xxhash64(F.lit(width), *[F.col(f"w.{c}{k}") for k in range(width)])
        if width == least == most and width >= LITERALS:
            return whole
        there = F.col(f"w.{c}{width - 1}").isNotNull()
        return F.when(there & (F.col("n") == width) if width < LITERALS else there, whole)
    if len(widths) == 1:
        both = F.when(hashed("w", most) == hashed("n", most), F.array(hashed("w", most))).otherwise(F.array(hashed("w", most), hashed("n", most)))
    else:
        both = F.array_distinct(F.array_compact(F.array(*[hashed(c, width) for width in widths for c in "wn"])))
    return out.select(*others, "pos", F.explode(both).alias("window"))


def _keyed(rows: DataFrame, id: str, text: str, name: str) -> DataFrame:
    key = F.col(id).cast("long")
    return rows.select(key.alias(name), F.xxhash64(key, text).alias("row"), F.coalesce(text, F.lit("")).alias("text"))


def _templated(rows: DataFrame, *names: str) -> DataFrame:
    """``names`` of rows with ``found``, and the two templates."""
    words, as_names = templates(F.col("found"))
    return rows.select(*names, words.alias("words"), as_names.alias("names"))


def _held(items: DataFrame, coverage: float) -> DataFrame:
    """The windows that find items: ``item_id, item, item_pos, window, total, slotted, whole``."""
    width = F.least(F.lit(WINDOW), F.size("found"))
    seen = items.select("item_id", "item", width.alias("width"), "found", F.explode(F.sequence(F.lit(0), F.size("found") - width)).alias("item_pos"))
    cut = F.slice("found", F.col("item_pos") + 1, F.col("width"))
    seen = _templated(seen.select("item_id", "item", "width", "item_pos", cut.alias("found")), "item_id", "item", "width", "item_pos", "found")

    def reading(c: str, below: str) -> Column:
        # The hash of ``windows``: the width and the hashes of the tokens.
        hashes = F.when(F.col("width") == WINDOW, F.xxhash64(F.lit(WINDOW), *[F.col(c)[k] for k in range(WINDOW)]))
        for w in range(1, WINDOW):
            hashes = hashes.when(F.col("width") == w, F.xxhash64(F.lit(w), *[F.get(c, F.lit(k)) for k in range(w)]))
        return F.struct(hashes.alias("window"), F.size(F.filter("found", lambda t: t < below)).alias("slots"))
    seen = seen.withColumns({"a": reading("words", INITIAL_MARK), "b": reading("names", END)}).withColumn(
        "usable", (F.col("width") == WINDOW) & (F.col("a.slots") <= WINDOW - LITERALS))
    totals = seen.groupBy(F.col("item").alias("of")).agg(
        F.count_distinct(F.when(F.col("usable"), F.col("item_pos"))).alias("total"), F.count_distinct("item_pos").alias("n"),
        F.min(F.struct("a.slots", "item_pos")).alias("best"))
    totals = totals.withColumn("whole", F.expr("total = 0") | (F.col("total") < coverage * F.col("n")))
    seen = seen.join(totals.drop("n"), F.col("item") == F.col("of")).filter(F.expr("if(whole, item_pos = best.item_pos, usable)"))
    read = seen.select("item_id", "item", "item_pos", "width", "total", "whole", F.explode(F.array("a", "b")).alias("r"))
    # As names, words that begin a sentence may leave a window too few words.
    read = read.filter(F.col("whole") | (F.col("r.slots") <= WINDOW - LITERALS))
    return read.groupBy("item_id", "item", "item_pos", "width", "total", "whole", "r.window").agg(F.min(F.col("r.slots") > 0).alias("slotted"))


def matches(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text",
            item_id: str = "item_id", item_text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """Contaminated documents: ``doc_id, row, item_id, windows, coverage, reworded``; ``row`` is a hash of id and text.

    ``reworded`` says that a placeholder's value differs from the item's.
    """
    items = _keyed(benchmark, item_id, item_text, "item_id").select("item_id", F.col("row").alias("item"), tokens(F.col("text")).alias("found"))
    items = stored(items.filter("size(found) > 0").distinct(), "items")
    held = stored(_held(items, coverage), "held")
    # The widths of the items' windows, at most five numbers: the documents are read once for all of them.
    widths = sorted(r[0] for r in held.select("width").distinct().collect()) or [WINDOW]

    texts = _keyed(docs, id, text, "doc_id")
    hashed = _templated(texts.select("doc_id", "row", tokens(F.col("text")).alias("found")), "doc_id", "row")
    met = windows(hashed, widths).join(held.drop("width"), "window").select("doc_id", "row", "pos", "item_id", "item", "item_pos", "total", "slotted", "whole")
    met = stored(met.groupBy("doc_id", "row", "pos", "item_id", "item", "item_pos", "total", "whole").agg(F.min("slotted").alias("slotted")), "hits")
    hits = met.filter("NOT whole").drop("whole")
    # Only pairs that could reach the coverage matter further on.
    pair = ("doc_id", "row", "item_id", "item")
    likely = stored(hits.groupBy(*pair, "total").agg(F.countDistinct("item_pos").alias("n")).filter(F.col("n") >= coverage * F.col("total")), "likely")
    hits = hits.join(likely.select("row", "item").distinct(), ["row", "item"]).withColumn("line", F.col("pos") - F.col("item_pos"))

    judged = stored(_judged(hits, texts, items), "judged")
    kept = hits.join(judged, ["row", "item", "line"], "left").filter("coalesce(agrees, true)")
    found = kept.groupBy(*pair, "total").agg(
        F.countDistinct("item_pos").alias("windows"), F.max(F.coalesce("other", F.lit(False))).alias("reworded"),
    ).filter(F.col("windows") >= coverage * F.col("total")).select(
        "doc_id", "row", "item_id", F.col("windows").cast("long").alias("windows"), (F.col("windows") / F.col("total")).alias("coverage"), "reworded").distinct()
    return found.unionByName(_whole(texts, items, met.filter("whole")))


def _judged(hits: DataFrame, texts: DataFrame, items: DataFrame) -> DataFrame:
    """``row, item, line, agrees, other`` of the alignments with placeholders: if their values agree with the leading ones, and if some differ from the item's."""
    line = ("row", "item", "line")
    slotted = stored(hits.filter("slotted").select(*line, "pos", "item_pos").distinct(), "slotted")
    sizes = hits.join(slotted.select(*line).distinct(), list(line), "left_semi").groupBy(*line).agg(F.countDistinct("item_pos").alias("n"))
    ours = texts.join(slotted.select("row").distinct(), "row", "left_semi").dropDuplicates(["row"]).select("row", tokens(F.col("text")).alias("found"))
    at = slotted.select(*line, F.explode(F.expr(f"sequence(pos, pos + {WINDOW - 1})")).alias("at")).distinct()
    values = at.join(ours, "row").join(items.select("item", F.col("found").alias("theirs")).distinct(), "item").select(
        *line, said(F.expr("found[at]")).alias("ours"), F.expr("theirs[at - line]").alias("theirs")).filter(F.col("theirs") < END)
    # A name is the same name at the beginning of a sentence.
    kind = F.when(F.col("theirs") >= INITIAL_MARK, NAME_MARK).otherwise(F.substring("theirs", 1, 1))
    values = values.select(*line, "ours", F.concat(kind, said(F.col("theirs"))).alias("theirs"))
    values = stored(values.groupBy(*line, "theirs").agg(F.min("ours").alias("low"), F.max("ours").alias("high")), "values")
    lines = values.groupBy(*line).agg(F.max(F.col("low") != F.col("high")).alias("torn")).join(sizes, list(line))
    values = stored(values.join(lines, list(line)), "lines")
    leading = values.groupBy("row", "item", "theirs").agg(F.max_by("low", F.struct(~F.col("torn"), "n", -F.col("line"))).alias("leading"))
    return values.join(leading, ["row", "item", "theirs"]).groupBy(*line).agg(
        F.min(~F.col("torn") & (F.col("low") == F.col("leading"))).alias("agrees"), F.max(F.expr("substring(theirs, 2) <> low")).alias("other"))


def _whole(texts: DataFrame, items: DataFrame, met: DataFrame) -> DataFrame:
    """Documents that hold whole templates of items, of those that ``met`` one of their windows."""
    # Places are gathered by stretches of a document, so that no list grows with a text.
    places = met.select("doc_id", "row", "item_id", "item", (F.col("pos") - F.col("item_pos")).alias("line")).filter("line >= 0")
    lines = stored(places.groupBy("doc_id", "row", "item_id", "item", F.expr("line div 4096").alias("stretch")).agg(
        F.collect_set("line").alias("lines")), "lines")
    words, as_names = templates(F.col("found"))
    theirs = items.select("item", "found", words.alias("their_words"), as_names.alias("their_names")).distinct().withColumnRenamed("found", "theirs")
    ours = texts.join(lines.select("row").distinct(), "row", "left_semi").dropDuplicates(["row"]).select("row", tokens(F.col("text")).alias("found"))
    ours = ours.select("row", words.alias("our_words"), as_names.alias("our_names"), F.transform("found", said).alias("ours"))
    n = F.size("theirs")
    plain = F.transform("theirs", said)

    def there(c: str, line: Column) -> Column:
        return F.slice(c, line + 1, n)

    def reading(name: str, below: str, line: Column) -> Column:
        literals = n - F.size(F.filter("theirs", lambda t: t < below))
        pairs = F.filter(F.arrays_zip(F.col("theirs").alias("t"), there("ours", line).alias("o")), lambda p: p["t"] < below)
        named = F.transform(pairs, lambda p: F.struct(
            F.concat(F.when(p["t"] >= INITIAL_MARK, NAME_MARK).otherwise(F.substring(p["t"], 1, 1)), said(p["t"])).alias("t"), p["o"].alias("o")))
        one_value = F.size(F.array_distinct(named)) == F.size(F.array_distinct(F.transform(named, lambda p: p["t"])))
        return (literals >= LITERALS) & (there(f"our_{name}", line) == F.col(f"their_{name}")) & one_value

    def holds(line: Column) -> Column:
        same = (there("ours", line) == plain) & (there("our_words", line) == F.col("their_words")) & ((n >= LITERALS) | (F.size("ours") == n))
        return same | reading("words", INITIAL_MARK, line) | reading("names", END, line)
    out = lines.join(ours, "row").join(theirs, "item").withColumn("good", F.filter("lines", holds)).filter("size(good) > 0")
    return out.groupBy("doc_id", "row", "item_id").agg(F.max(F.exists("good", lambda x: there("ours", x) != plain)).alias("reworded")).select(
        "doc_id", "row", "item_id", F.lit(1).cast("long").alias("windows"), F.lit(1.0).alias("coverage"), "reworded")


def clean(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated ones, columns as they were."""
    [name] = unused(docs.columns, "_row")
    found = stored(matches(docs, benchmark, id=id, text=text, **options).select(F.col("row").alias(name)).distinct(), "contaminated")
    return docs.withColumn(name, F.xxhash64(F.col(id).cast("long"), text)).join(found, name, "left_anti").drop(name)
