"""Benchmark decontamination by template windows.

A text becomes its *template*: lower-case tokens with numbers, names (words
capitalised inside a sentence) and units (after a number) replaced by the
typed placeholders ``<num>``, ``<name>``, ``<unit>``; what a placeholder stands
for is its slot value. Every window of five template tokens of every document
is hash-joined to the benchmark's windows. A document contains an item if it
has at least 0.8 of the item's distinct windows, and if the slots agree: an
item's slot value must stand for one value (0.8 of the matched slots at least),
as in a question asked again with other numbers. This holds throughout the
document, or in any one occurrence of the item: matched windows that have one
offset (position in the document less position in the item), or offsets within
a quarter of the item, and at least 0.8 of the item's windows.

A window has a second, case-free form, in which names are words like others; for
a window without a name both are the same. An item's window is matched by either
form, so lower-case, upper-case and title-case copies and names after a line
break, a tab or several spaces are found too.

DataFrame expressions only. Windows are made and joined in the task that reads
the text, the benchmark's windows are broadcast if their measured size allows it
(else the join shuffles), and only matching windows go on, counted by combinable
aggregates. Slots are looked at in a second reading of those documents that
have enough windows of an item with slots.

Nulls and edges: null or empty texts and documents of fewer than five tokens
contain nothing; items of fewer than five tokens, or without a window of at
least three words that are not placeholders, are too unspecific and match
nothing; null ids are carried; rows that repeat an id are judged apart and
reported together; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindle.llm.common import null_safe, solid

# Number words, and units that follow a number.
NUMBER_WORDS = ("two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred "
                "thousand million billion half dozen").split()
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound "
         "pounds lb lbs oz ounce ounces ton tons ml l liter liters litre litres gallon gallons second seconds "
         "minute minutes hour hours day days week weeks month months year years dollar dollars cent cents euro "
         "euros percent degree degrees kmh mph hz khz mhz ghz kb mb gb tb w kw v volt volts watt watts").split()
SIGNS = "%$€£¥°"
MARK = "\u0002"          # put before a word that is capitalised inside a sentence
BREAK = "\u0003"         # the same after other white space: no name, only capitalised
GAP = "\u0001"
NAME = "([\\p{L}\\p{N},;]) (\\p{Lu})"
BROKEN = "([\\p{L}\\p{N},;])[\\t\\n\\x0B\\f\\r\\p{Z}]+(\\p{Lu})"
TOKEN = "[" + MARK + BREAK + "]?[\\p{L}\\p{M}]+|[0-9]+(?:[.,:/][0-9]+)*|[" + SIGNS + "]"
MAX_BROADCAST = 64 << 20


def tokens(text: Column) -> Column:
    marked = F.regexp_replace(F.regexp_replace(text, NAME, "$1 " + MARK + "$2"), BROKEN, "$1 " + BREAK + "$2")
    return F.regexp_extract_all(F.lower(marked), F.lit(TOKEN), F.lit(0))


def any_of(words: list[str]) -> str:
    """A pattern for the words, branching at their first letters."""
    heads = sorted({w[0] for w in words})
    return "(?:" + "|".join(f"{h}(?:{'|'.join(sorted((w[1:] for w in words if w[0] == h), key=len, reverse=True))})" for h in heads) + ")"


def typed(tok: Column) -> Column:
    """An array of tokens as one line, a space around each, with numbers and
    units replaced: patterns over the line cost far less than an expression for
    each token. Marks stay before the other words."""
    line = F.concat(F.lit(" "), F.array_join(tok, " "), F.lit(" "))
    for pattern, mark in (("[0-9][^ ]*", "<num>"), (f" [{MARK}{BREAK}]?{any_of(NUMBER_WORDS)}(?= )", " <num>"),
                          (f"[{SIGNS}]", "<unit>"), (f"<num> [{MARK}{BREAK}]?{any_of(UNITS)}(?= )", "<num> <unit>")):
        line = F.regexp_replace(line, pattern, mark)
    return line


def split(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(" ")), " ")


def case_free(line: Column) -> Column:
    return split(F.translate(line, MARK + BREAK, ""))


def template(line: Column) -> Column:
    return split(F.regexp_replace(F.translate(line, BREAK, ""), f"{MARK}[^ ]*", "<name>"))


def window_hashes(texts: DataFrame, width: int) -> DataFrame:
    """``h`` of every window, in its case-free form and, where this differs, as
    a template. Columns other than ``text`` are kept."""
    kept = [c for c in texts.columns if c != "text"]

    def hashes(tok: Column) -> Column:
        return F.transform(tok, lambda x: F.xxhash64(x))
    # No filter on a computed array, here or below: it would be moved beneath
    # the projections and tokenize the text once more for each token.
    step = texts.select(*kept, typed(tokens(F.col("text"))).alias("line"))
    step = step.select(*kept, hashes(case_free(F.col("line"))).alias("free"),
                       F.when(F.col("line").contains(MARK), hashes(template(F.col("line")))).alias("c"))

    # Single elements: a slice would copy the whole array for each window.
    def window(of: str, i: Column) -> Column:
        return F.xxhash64(*(F.get(of, i + j if j else i) for j in range(width)))
    name = F.xxhash64(F.lit("<name>"))
    at = F.sequence(F.lit(0), F.greatest(F.size("free") - width, F.lit(0)))
    named = F.transform(at, lambda i: F.when(reduce(Column.__or__, (F.get("c", i + j) == name for j in range(width))), window("c", i)))
    plain = F.transform(at, lambda i: window("free", i))
    both = F.when(F.col("c").isNotNull(), F.concat(plain, named)).otherwise(plain)
    made = step.select(*kept, F.when(F.size("free") >= width, both).alias("w"))
    return made.select(*kept, F.explode_outer("w").alias("h")).where("h IS NOT NULL")


def windows(texts: DataFrame, width: int = 5) -> DataFrame:
    """Windows in detail: ``h``, ``pos``, ``slots`` (values in order, joined by
    GAP), ``plain`` (``h`` of the template), ``words`` (tokens that are no
    placeholders in it) and ``form`` (1 for the template; 2 for the case-free
    form, if that differs). Columns other than ``text`` are kept."""
    kept = [c for c in texts.columns if c != "text"]
    step = texts.select(*kept, tokens(F.col("text")).alias("t"))
    step = step.select(*kept, F.transform("t", lambda x: F.translate(x, MARK + BREAK, "")).alias("t"), typed(F.col("t")).alias("line"))
    step = step.select(*kept, "t", template(F.col("line")).alias("c"), case_free(F.col("line")).alias("free"))

    def values(name: str) -> Column:
        return F.zip_with(name, "t", lambda c, t: F.when(c != t, t))
    step = step.select(*kept, "c", "free", values("c").alias("v"), values("free").alias("fv"))

    def window(i: Column, of: str, values: str, form: int) -> Column:
        def made(name: str) -> Column:
            return F.xxhash64(*(F.xxhash64(F.get(name, i + j)) for j in range(width)))
        own = [F.get(values, i + j) for j in range(width)]
        words = sum((F.get("v", i + j).isNull().cast("int") for j in range(width)), F.lit(0))
        found = F.struct(made(of).alias("h"), i.alias("pos"), F.concat_ws(GAP, *own).alias("slots"), made("c").alias("plain"),
                         words.alias("words"), F.lit(form).alias("form"))
        return found if form == 1 else F.when(made(of) != made("c"), found)
    at = F.sequence(F.lit(0), F.greatest(F.size("c") - width, F.lit(0)))
    both = F.concat(F.transform(at, lambda i: window(i, "c", "v", 1)), F.transform(at, lambda i: window(i, "free", "fv", 2)))
    made = step.select(*kept, F.when(F.size("c") >= width, both).alias("w"))
    return made.select(*kept, F.explode_outer("w").alias("w")).select(*kept, "w.*").where("h IS NOT NULL")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", width: int = 5,
                 share: float = 0.8, agree: float = 0.8, least_words: int = 3) -> DataFrame:
    """Rows ``doc_id``, ``th`` (hash of the text), ``item_id``, ``n_windows``
    (of the item), ``n_matched``, ``n_slots``, ``agreement`` (of the slots;
    null without any)."""
    own = F.col(item_text_col).cast("string")
    made = (windows(benchmark.select(F.col(item_id_col).alias("item_id"), F.xxhash64(own).alias("it"), own.alias("text")), width)
            .where(F.col("words") >= least_words)
            .select("item_id", "it", F.col("pos").alias("item_pos"), F.col("h").alias("item_h"), F.col("slots").alias("item_slots"), "plain", F.col("form").alias("item_form")).distinct())
    # One position of each window, with the least slots, votes for the whole document.
    first = Window.partitionBy("item_id", "item_h").orderBy("item_form", "item_slots", "it", "item_pos", "plain")
    places = solid(made.withColumn("first", F.row_number().over(first) == 1), "decon-places")
    sizes = places.where("first AND item_form = 1").groupBy("item_id").agg(F.count("*").alias("n_windows"))
    lengths = places.where("item_form = 1").groupBy("item_id", "it").agg(F.count("*").alias("n_places"))
    p, n, m = places.alias("p"), sizes.alias("s"), lengths.alias("m")
    items = (p.join(n, F.col("p.item_id").eqNullSafe(F.col("s.item_id")))
             .join(m, F.col("p.item_id").eqNullSafe(F.col("m.item_id")) & (F.col("p.it") == F.col("m.it"))))
    items = solid(items.select("p.item_id", "p.it", "item_pos", "item_h", "item_slots", "plain", "item_form", "first", "n_windows", "n_places"), "decon-items")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.xxhash64(F.col(text_col).cast("string")).alias("th"), F.col(text_col).cast("string").alias("text"))
    key = ["doc_id", "th", "item_id"]

    # Windows of documents that some item has.
    listed = items.select("item_id", "item_h", "plain", "item_form", "n_windows").distinct()
    met = window_hashes(texts, width).join(small(listed), F.col("h") == F.col("item_h"))
    enough = F.lit(share) * F.col("n_windows")
    found = solid(met.groupBy(*key, "plain", "n_windows").agg(F.min("item_form").alias("form"))
                  .groupBy(*key, "n_windows").agg(F.count("*").alias("n_matched"), F.count(F.when(F.col("form") == 1, 1)).alias("n_first"))
                  .where(F.col("n_matched") >= enough).select(*key, "n_windows", "n_matched", (F.col("n_first") >= enough).alias("first_form")), "decon-found")
    # Only where an item has slots, the documents that may contain it are opened
    # again to hold their slots against the item's.
    slotted = items.where("item_slots <> ''").select(F.col("item_id").alias("slotted")).distinct()
    doubtful = solid(found.join(small(slotted), F.col("item_id").eqNullSafe(F.col("slotted")), "left_semi").select(*key, "first_form"), "decon-doubtful")
    again = doubtful.select(F.col("doc_id").alias("a"), F.col("th").alias("b")).distinct()
    opened = texts.join(small(again), null_safe([(F.col("doc_id"), F.col("a"))]) & (F.col("th") == F.col("b")), "left_semi")
    votes = solid(judged(windows(opened, width).select(*key[:2], "h", "pos", "slots").join(small(items), F.col("h") == F.col("item_h")), doubtful, key, share), "decon-votes")
    f, s = found.alias("f"), votes.alias("v")
    return (f.join(s, null_safe((F.col(f"f.{k}"), F.col(f"v.{k}")) for k in key), "left")
            .select(*(F.col(f"f.{k}") for k in key), "n_windows", "n_matched",
                    F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"), "agreement")
            .where(F.col("agreement").isNull() | (F.col("agreement") >= agree)))


def judged(met: DataFrame, doubtful: DataFrame, key: list[str], share: float) -> DataFrame:
    """For each pair of ``doubtful`` with slots the number of slots that the
    whole document votes on, and the best ``agreement``: of the whole document
    or of an occurrence that has ``share`` of the item's windows (1 if it has
    none with slots)."""
    m, d = met.alias("m"), small(doubtful).alias("d")
    met = m.join(d, null_safe((F.col(f"m.{k}"), F.col(f"d.{k}")) for k in key)).select("m.*", "first_form")
    off, near = F.col("pos") - F.col("item_pos"), F.greatest(F.lit(1), F.floor(F.col("n_places") / 4))
    half = F.floor(near / 2)

    def group(level: int, at: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), at.cast("long").alias("at"))
    # Offsets that differ by half of ``near`` at most share a band of level 1 or 2.
    levels = [group(0, off), group(1, F.floor(off / near)), group(2, F.floor((off + half) / near))]
    every = met.select(*key, "it", "item_pos", "n_places", "item_slots", "slots", F.explode(F.array(*levels)).alias("g"))
    own = [*key, "it", "level", "at"]
    every = every.select(*key, "it", "g.*", "item_pos", "n_places", "item_slots", "slots")
    # Case-free windows vote there only where the first form alone has too few.
    whole = met.where("first AND (item_form = 1 OR NOT first_form)").select(
        *key, F.lit(0).cast("long").alias("it"), F.lit(-1).alias("level"), F.lit(0).cast("long").alias("at"), "item_slots", "slots")
    pair = F.explode(F.arrays_zip(F.split("item_slots", GAP).alias("a"), F.split("slots", GAP).alias("b")))
    votes = (every.select(whole.columns).unionByName(whole).where("item_slots <> ''").select(*own, pair.alias("p"))
             .groupBy(*own, F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count("*").alias("n"))
             .groupBy(*own, "a").agg(F.max("n").alias("best"), F.sum("n").alias("n"))
             .groupBy(*own).agg(F.count("*").alias("n_slots"), (F.sum("best") / F.sum("n")).alias("agreement"), F.lit(False).alias("held")))
    held = (every.groupBy(*own, "n_places", "item_pos").agg(F.count("*").alias("n"))
            .groupBy(*own, "n_places").agg(F.count("*").alias("n")).where(F.col("n") >= F.lit(share) * F.col("n_places"))
            .select(*own, F.lit(None).cast("long").alias("n_slots"), F.lit(None).cast("double").alias("agreement"), F.lit(True).alias("held")))
    counted = F.col("held") | (F.col("level") == -1)
    return (votes.unionByName(held).groupBy(*own)
            .agg(F.max("n_slots").alias("n_slots"), F.max("agreement").alias("agreement"), F.max("held").alias("held")).where(counted)
            .groupBy(*key).agg(F.max(F.when(F.col("level") == -1, F.col("n_slots"))).alias("n_slots"),
                               F.max(F.coalesce("agreement", F.lit(1.0))).alias("agreement"))
            # Without any vote of the whole document there are no slots to agree.
            .where("n_slots IS NOT NULL"))


def small(table: DataFrame) -> DataFrame:
    """With a broadcast hint if its measured size allows it."""
    size = F.lit(16 * len(table.columns))
    for f in table.schema.fields:
        if f.dataType.typeName() == "string":
            size = size + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
    return F.broadcast(table) if (table.agg(F.sum(size)).first()[0] or 0) <= MAX_BROADCAST else table


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that contain no item of ``benchmark``."""
    found = solid(contaminated(docs, benchmark, id_col, text_col, **limits).select("doc_id", "th").distinct(), "decon-found")
    # Rows travel boxed, so that none of their names can clash with another.
    boxed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    return boxed.join(found, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("text_hash") == F.col("th")), "left_anti").select("row.*")
