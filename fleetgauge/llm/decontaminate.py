"""Benchmark decontamination by templates, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import hand_off

WINDOW = 8
MIN_SHARE = 0.2
VERBATIM = 13  # words in a row, without a changed one, that are enough of an item of any length
BROADCAST_ROWS = 1_000_000  # distinct window hashes of 8 bytes that are sent to every executor

WHOLE_UNIT = 3  # letters; shorter names are units only after a number

# Names of units.
UNITS = [
    "mm", "cm", "m", "km", "in", "ft", "mi", "inch", "inches", "feet", "mile", "miles", "meter", "meters", "metre", "metres",
    "mg", "g", "kg", "t", "lb", "lbs", "oz", "gram", "grams", "pound", "pounds", "tons", "ml", "l", "liter", "liters", "litre", "litres",
    "ms", "s", "h", "sec", "min", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month",
    "months", "year", "years", "usd", "eur", "dollar", "dollars", "cent", "cents", "euro", "euros", "percent", "mph", "kmh", "w", "kw",
    "v", "kb", "mb", "gb", "tb", "degrees",
]

# Points and commas inside a number belong to it; a letter right after a digit starts a word.
SEPARATORS = r"(?:[^\p{L}\p{N}.,]|[.,](?!\p{N})|(?<!\p{N})[.,])+|(?<=\p{N})(?=\p{L})"


def words(text: str | Column) -> Column:
    """Words and numbers of a text; none of a null or empty one."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1), lambda w: w != "")


def _typed(w: Column, i: Column, all_words: Column, names: bool) -> Column:
    low = F.lower(w)
    digit = lambda x: F.ascii(x).between(48, 57)
    unit = low.isin(UNITS) & ((F.length(w) >= WHOLE_UNIT) | digit(F.coalesce(F.get(all_words, i - 1), F.lit(""))))
    out = F.when(digit(w), "<num>")
    if names:
        out = out.when((low != w) & (F.upper(w) != w), "<name>")
    return out.when(unit, "<unit>").otherwise(low)  # index -1, before the first word, is null


def template(words_col: str, names: bool = True) -> Column:
    """Lower-cased words; numbers, units and, if ``names``, words in mixed case as placeholders."""
    col = F.col(words_col)
    return F.transform(col, lambda w, i: _typed(w, i, col, names))


def windows(template_col: str, n: int) -> Column:
    """The hash of every run of ``n`` template words; none where there are fewer."""
    col = F.col(template_col)
    starts = F.sequence(F.lit(1), F.size(col) - n + 1)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(col, i, n)))
    return F.when(F.size(col) >= n, hashes).otherwise(F.array().cast("array<long>"))


# What stands for a number, a name and a unit in a template.
PLACEHOLDERS = ["<num>", "<name>", "<unit>"]


def _literal(words_of: Column) -> Column:
    """Whether a run of template words has one that is no placeholder; others say nothing about where they come from."""
    return F.exists(words_of, lambda w: ~w.isin(PLACEHOLDERS))


def _slots(item_words: Column, doc_words: Column, at: Column) -> Column:
    """(a, b, place) of the words of an item that were replaced in its template, with what the document has there."""
    met = F.zip_with(item_words, F.transform(doc_words, lambda w, i: F.struct(F.lower(w).alias("b"), (at + i).alias("place"))), lambda a, d: F.struct(
        F.lower(a).alias("a"), d["b"].alias("b"), d["place"].alias("place"), ((F.lower(a) != a) | F.ascii(a).between(48, 57) | F.lower(a).isin(UNITS)).alias("slot"),
    ))
    return F.transform(F.filter(met, lambda s: s["slot"]), lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"), s["place"].alias("place")))


def _longest_run(places: Column) -> Column:
    """How many of the sorted, distinct places follow one another at most."""
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s, x):
        run = F.when(x == s["last"] + 1, s["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(places, start, step, lambda s: s["best"])


def _at_odds(slots: Column) -> Column:
    """Whether some value on the benchmark side meets two in the document."""
    pairs = F.array_distinct(F.transform(slots, lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"))))
    return F.size(pairs) > F.size(F.array_distinct(F.transform(pairs, lambda p: p["a"])))


def _sound(lines: DataFrame, line: list[str]) -> DataFrame:
    """``line`` and the sound windows (item_at, slots) of alignments in which values are at odds.

    Sound are windows without a changed slot, and those whose values are each the one that their benchmark value meets
    at most places of the alignment. Places are counted by grouping, so a table of numbers costs no more than its slots.
    """
    every = lines.select(*line, F.explode("found").alias("f")).select(*line, "f.item_at", "f.slots")
    uses = every.select(*line, F.explode("slots").alias("s")).select(*line, "s.a", "s.b", "s.place").distinct()
    counted = uses.groupBy(*line, "a", "b").agg(F.count("*").alias("n"))
    most = counted.groupBy(*line, "a").agg(F.max("n").alias("n"))
    key = lambda extra: [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*line, *extra]]  # noqa: E731  ids may be null
    usual = counted.alias("l").join(most.alias("r"), key(["a", "n"]), "left_semi")
    usual = usual.groupBy(*line, "a").agg(F.count("*").alias("ties"), F.min("b").alias("usual")).where("ties = 1")
    slots = every.select(*line, "item_at", F.explode("slots").alias("s")).select(*line, "item_at", "s.a", "s.b")
    judged = slots.alias("l").join(usual.alias("r"), key(["a"]), "left").select("l.*", "r.usual")
    judged = judged.groupBy(*line, "item_at").agg(
        F.min(F.col("a") == F.col("b")).alias("same"), F.min(F.coalesce(F.col("b") == F.col("usual"), F.lit(False))).alias("fits")
    )
    bad = judged.where("NOT same AND NOT fits")
    return every.alias("l").join(bad.alias("r"), key(["item_at"]), "left_anti")


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, hash, words): a text is named by its id and hash, so ids that repeat or are null do not mix texts."""
    return df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), words(text_col).alias("words"))


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
         n: int = WINDOW, min_share: float = MIN_SHARE, verbatim: int = VERBATIM) -> DataFrame:
    """Documents that hold benchmark items, verbatim or with other numbers, names and units.

    Returns (id, hash, item, n_matched, n_windows, changed): one row for each document text and item of
    which at least ``min_share`` of the windows, and one at least, is found, or ``verbatim`` words in a row without a changed one. ``changed``
    counts the values of the item that are others in the document, in the alignment of the two that has most windows.

    Texts become templates (``template``); each run of ``n`` template words with one that is no placeholder is a window.
    Benchmark windows are hashed both with names typed and with names as plain words, so a document in one case is met too.
    Windows that meet by hash are aligned by the difference of their places. A window
    counts if none of its slots is changed, or if each value on the benchmark side stands for the value it meets at most places
    of the alignment; where two are met equally often, for neither. An item of fewer than ``n`` words, one of them no placeholder, is found in a text whose whole
    template is its own, if no value meets two.

    Null texts and those of placeholders alone match nothing. Rows with the same id and text count once; benchmark rows are taken by id and
    text too, and those without an id are left out. Documents without a match
    give no row. The hash set of the benchmark is broadcast only up to ``BROADCAST_ROWS``; beyond, both sides are shuffled by hash.
    """
    items = _texts(benchmark, item_col, text_col).where("id IS NOT NULL").distinct()
    typed = items.withColumn("typed", template("words")).withColumn("plain", template("words", names=False))
    both = typed.select("id", "hash", "words", F.explode(F.array_distinct(F.array("typed", "plain"))).alias("t"))
    item = [F.col("id").alias("item"), F.col("hash").alias("item_hash")]
    item_windows = both.select(*item, "t", F.posexplode(windows("t", n)).alias("item_at", "window"))
    item_windows = item_windows.where(_literal(F.slice("t", F.col("item_at") + 1, n))).drop("t").distinct()
    sizes = item_windows.groupBy("item", "item_hash").agg(F.count_distinct("item_at").cast("int").alias("n_windows"))
    item_windows = item_windows.join(sizes, ["item", "item_hash"])
    known = item_windows.select("window").distinct()
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    texts = _texts(docs, id_col, text_col).withColumn("t", template("words"))
    places = texts.select("id", "hash", F.posexplode(windows("t", n)).alias("at", "window")).join(known, "window", "left_semi")
    # Few windows are left; the values of their slots come from the words of the texts that hold them.
    hits = places.distinct().groupBy("id", "hash").agg(F.collect_list(F.struct("at", "window")).alias("places"))
    whole = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    held = whole.alias("t").join(hits.alias("h"), (F.col("t.hash") == F.col("h.hash")) & F.col("t.id").eqNullSafe(F.col("h.id")))
    held = held.select("t.id", "t.hash", "t.text", "h.places").dropDuplicates(["id", "hash"]).select("id", "hash", words("text").alias("words"), "places")
    doc_side = held.select("id", "hash", "words", F.explode("places").alias("p")).select(
        "id", "hash", F.col("p.at").alias("at"), F.col("p.window").alias("window"), F.slice("words", F.col("p.at") + 1, n).alias("doc_words")
    )
    item_side = item_windows.join(
        items.select(*item, F.col("words").alias("item_words")),
        ["item", "item_hash"],
    ).select("item", "item_hash", "n_windows", "item_at", "window", F.slice("item_words", F.col("item_at") + 1, n).alias("item_words"))
    met = doc_side.join(item_side, "window")
    key = ["id", "hash", "item", "item_hash", "n_windows"]
    line = [*key, "shift"]
    slots = _slots(F.col("item_words"), F.col("doc_words"), F.col("item_at"))
    lines = met.select(*key, (F.col("at") - F.col("item_at")).alias("shift"), "item_at", slots.alias("slots"))
    lines = lines.groupBy(*line).agg(F.collect_set(F.struct("item_at", "slots")).alias("found"))
    uses = F.array_distinct(F.flatten(F.transform("found", lambda f: f["slots"])))
    lines = hand_off(lines.withColumn("at_odds", _at_odds(uses)), "alignments")
    mended = _sound(lines.where("at_odds").drop("at_odds"), line).groupBy(*line).agg(F.collect_set(F.struct("item_at", "slots")).alias("found"))
    sound = lines.where("NOT at_odds").drop("at_odds").unionByName(mended)

    other = F.filter(F.flatten(F.transform("found", lambda f: f["slots"])), lambda s: s["a"] != s["b"])
    changed = F.size(F.array_distinct(F.transform(other, lambda s: s["a"])))
    same = F.filter("found", lambda f: F.forall(f["slots"], lambda s: s["a"] == s["b"]))
    run = _longest_run(F.array_sort(F.array_distinct(F.transform(same, lambda f: f["item_at"]))))
    at = F.array_distinct(F.transform("found", lambda f: f["item_at"]))
    sound = sound.select(*key, at.alias("found"), changed.alias("changed"), run.alias("run"))
    best = F.max_by("changed", F.struct("size", -F.col("changed")))
    total = sound.select(*key, "changed", "run", F.size("found").alias("size"), F.explode("found").alias("item_at")).groupBy(*key).agg(
        F.size(F.collect_set("item_at")).alias("n_matched"), best.alias("changed"), F.max("run").alias("run")
    )
    need = F.greatest(F.lit(1), F.ceil(F.col("n_windows") * min_share))
    long = total.where((F.col("n_matched") >= need) | (F.col("run") >= max(1, verbatim - n + 1)))
    return long.unionByName(_short(both, items, texts, n), allowMissingColumns=True).groupBy("id", "hash", "item").agg(
        F.max("n_matched").cast("long").alias("n_matched"), F.max("n_windows").cast("long").alias("n_windows"), F.max("changed").cast("long").alias("changed")
    )


def _short(both: DataFrame, items: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """Items of fewer than ``n`` words in texts with the same whole template; such an item is one window."""
    short = lambda df: df.where((F.size("t") > 0) & (F.size("t") < n))
    whole = short(both).where(_literal(F.col("t"))).select(
        F.col("id").alias("item"), F.col("hash").alias("item_hash"), F.col("words").alias("item_words"), F.xxhash64("t").alias("window")
    ).distinct()
    own = short(texts).select("id", "hash", F.col("words").alias("doc_words"), F.xxhash64("t").alias("window"))
    met = own.join(whole, "window").withColumn("slots", _slots(F.col("item_words"), F.col("doc_words"), F.lit(0)))
    changed = F.size(F.array_distinct(F.transform(F.filter("slots", lambda s: s["a"] != s["b"]), lambda s: s["a"])))
    one = F.lit(1).alias("n_windows")
    return met.where(~_at_odds(F.col("slots"))).select("id", "hash", "item", one, F.lit(1).alias("n_matched"), changed.alias("changed"))
