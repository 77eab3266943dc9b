"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Numbers, names and units become typed placeholders, so that a question with other parameters keeps its template. Windows of
``WINDOW`` tokens of all documents are hash-joined with those of the benchmark twice: by their plain lower-case tokens, and by
their template if it has placeholders, up to ``MOST_SLOTS``. Windows at the same distance form
one alignment of a document with an item, and windows in a row one run of it. A run's slots must be consistent: every value
of the item stands for one and the same value of the document. Of other runs only windows count that agree word for word and
have no slot or lie in a literal run of more than ``WINDOWS_IN_A_ROW`` windows. An alignment counts if enough windows do.

The search has two passes with one result: the first takes the hashes of all windows of every document and finds the rows that
share any with an item, the second takes the slots as well, of those rows only.

The benchmark's windows are broadcast only if they were counted and are few; beyond that both sides are shuffled by the hash
and Spark splits hot hashes. Rows that are shuffled hold hashes and the slot values of one window, never a text.

Null texts have no tokens and match nothing. An item of fewer tokens than a window is one window of its own length, which is
looked for in all documents (lengths that no item has are not); its template counts inside longer texts only if at most half
of it are placeholders. Every row of both tables gets a number first and is judged by itself, whatever its doc_id or item_id;
rows that agree in both ids (null included) are one row of the result. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeloom.llm.shared import BROADCAST_NUMBERS, ROW, numbered, only_rows, text_of, without_rows
from tradeloom.session import written, written_alone

WINDOW = 8
MOST_SLOTS = 4  # a template with more placeholders says too little; such windows are found by their plain tokens
WINDOWS_IN_A_ROW = 6  # 13 tokens if in a row; half of the windows for shorter items
BROADCAST_WINDOWS = 500_000  # some 30 MB

# White space and punctuation end a token.
BREAKS = r"[ \t\n\x0B\f\r!-/:-@\[-`{-~«»„“”‘’…–—¿¡]+"
# Numbers, and capitals inside a sentence: they begin a slot.
SLOT_BEGINS = r"(?<=[a-zß-ÿ,;] )[A-ZÀ-Þ]|[0-9]+"

# The mark put before a slot and the placeholders (private-use characters), the units known after a number.
MARK, NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002", "\ue003"
UNITS = ["kg", "g", "mg", "km", "m", "cm", "mm", "mi", "ft", "l", "ml", "s", "ms", "min", "h", "hours", "minutes", "seconds",
         "days", "weeks", "months", "years", "meters", "metres", "miles", "feet", "inches", "pounds", "dollars", "euros",
         "percent", "kmh", "mph", "degrees", "celsius", "usd", "eur"]


def _is_number(token: Column) -> Column:
    return (token >= MARK + "0") & (token < MARK + ":")


def _template_token(token: Column, i: Column) -> Column:
    before = F.get(F.col("tokens"), i - 1)
    return (F.when(_is_number(token), NUMBER).when(token >= MARK, NAME)
            .when((i > 0) & token.isin(UNITS) & _is_number(before), UNIT).otherwise(token))


def with_templates(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key, lower-case ``tokens``, these without marks as ``plain`` and, where any is a slot, the ``template`` with placeholders."""
    marked = F.lower(F.regexp_replace(text_of(text), SLOT_BEGINS, f"{MARK}$0"))
    return (df.select(F.col(key), marked.alias("marked"))
            .withColumn("tokens", F.filter(F.split("marked", BREAKS), lambda token: token != ""))
            .withColumn("template", F.when(F.col("marked").contains(MARK), F.transform("tokens", _template_token)))
            .withColumn("plain", F.when(F.col("marked").contains(MARK), F.transform("tokens", lambda t: F.translate(t, MARK, "")))
                        .otherwise(F.col("tokens"))))


def _hash(hashes: str, i: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(F.col(hashes), i + k) for k in range(length)])


def _hashed(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key, token hashes ``plain`` and ``template`` (null without slots), the ``values`` of the slots at their places."""
    values = F.when(F.col("template").isNotNull(), F.zip_with(
        "template", "tokens", lambda t, token: F.when(t.isin(NUMBER, NAME, UNIT), F.concat(t, token))))
    hashes = [F.transform(c, lambda t: F.xxhash64(t)).alias(c) for c in ("plain", "template")]
    return with_templates(df, key, text).select(key, *hashes, values.alias("values"))


def _exploded(hashed: DataFrame, key: str, windows: list[Column]) -> DataFrame:
    whole = hashed.select(key, F.concat(*[F.coalesce(w, F.array()) for w in windows]).alias("windows"))
    # the outer form: for the inner one a filter on the whole expression is pushed to the scan, and it is computed twice
    return whole.select(key, F.explode_outer("windows").alias("w")).where(F.col("w").isNotNull())


def _places(length: int) -> Column:
    return F.sequence(F.lit(0), F.size("plain") - length)


def window_hashes(df: DataFrame, key: str, text: str, lengths: list[int]) -> DataFrame:
    """Key and ``h`` of every window of these lengths, by plain tokens and, in texts with slots, by template."""
    windows = [F.when((F.size("plain") >= k) & F.col(c).isNotNull(), F.transform(_places(k), lambda i: _hash(c, i, k)))
               for k in lengths for c in ("plain", "template")]
    return _exploded(_hashed(df, key, text), key, windows).select(key, F.col("w").alias("h"))


def windows(df: DataFrame, key: str, text: str, lengths: list[int], items: bool = False) -> DataFrame:
    """One row per window and kind of hash: key, ``at``, ``h``, ``literal`` (by plain tokens), the values of its ``slots``.

    For ``items``, texts shorter than a window are one window only."""
    def window(i: Column, k: int, c: str) -> Column:
        inside = F.coalesce(F.array_compact(F.slice("values", i + 1, k)), F.array().cast("array<string>"))
        return F.struct(i.alias("at"), _hash(c, i, k).alias("h"), F.lit(c == "plain").alias("literal"), inside.alias("slots"))

    size = F.size("plain")
    made = []
    for k in lengths:
        fits = (size == k) if items and k < WINDOW else (size >= k)
        n_slots = lambda w: F.size(w["slots"])
        most = F.when((size == k) | F.lit(items), MOST_SLOTS).otherwise(MOST_SLOTS * k // WINDOW)
        made.append(F.when(fits, F.transform(_places(k), lambda i: window(i, k, "plain"))))
        made.append(F.when(fits & F.col("template").isNotNull(), F.filter(
            F.transform(_places(k), lambda i: window(i, k, "template")), lambda w: (n_slots(w) > 0) & (n_slots(w) <= most))))
    empty = F.array().cast("array<struct<at:int,h:bigint,literal:boolean,slots:array<string>>>")
    return _exploded(_hashed(df, key, text), key, [F.coalesce(m, empty) for m in made]).select(key, "w.*")


def leaking_rows(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """One row per numbered document and item that it leaks: ``ROW``, ``item`` (the number of the item's row),
    ``matched_windows`` of the best alignment, ``item_windows`` and ``same_values``."""
    key, item = ROW, "item"
    benchmark = benchmark.select(F.col(ROW).alias(item), text)
    found = windows(benchmark, item, text, list(range(1, WINDOW + 1)), items=True).withColumnRenamed("slots", "item_slots")
    needed = F.least(F.lit(WINDOWS_IN_A_ROW), F.ceil(F.col("item_windows") / 2).cast("int"))
    sizes = found.where("literal").groupBy(item).agg(F.count(F.lit(1)).alias("item_windows")).withColumn("needed", needed)
    side = found.select(item, F.col("at").alias("item_at"), "h", "literal", "item_slots").join(sizes, item)
    small = side.count() <= BROADCAST_WINDOWS
    side = F.broadcast(side) if small else side
    length = F.least(F.size("plain"), F.lit(WINDOW))
    lengths = sorted(r[0] for r in with_templates(benchmark, item, text).select(length).distinct().collect() if r[0])
    if not lengths:
        lengths = [WINDOW]

    every = window_hashes(docs, key, text, lengths)
    hashes = side.select("h").distinct()
    # shuffled, a window that a row repeats goes once
    suspects = (every if small else every.distinct()).join(F.broadcast(hashes) if small else hashes, "h", "left_semi").select(key).distinct()
    again = only_rows(docs.select(key, text), key, written(suspects, "suspects"))

    # plain tokens that agree stand for themselves, whether or not they are slots in the document
    hits = windows(again, key, text, lengths).drop("literal").join(side, "h").withColumn(
        "pairs", F.zip_with("item_slots", F.when(F.col("literal"), F.col("item_slots")).otherwise(F.col("slots")),
                            lambda a, b: F.struct(a.alias("item_slots"), b.alias("slots"))))
    place = [key, item, "item_windows", "needed", "shift"]
    hits = hits.withColumn("shift", F.col("at") - F.col("item_at"))
    in_order = lambda *more: Window.partitionBy(*place, *more).orderBy("item_at")
    hits = (hits.withColumn("run", F.col("item_at") - F.dense_rank().over(in_order()))
            .withColumn("literal_run", F.col("item_at") - F.dense_rank().over(in_order("literal")))
            .withColumn("literal_windows", F.count(F.lit(1)).over(Window.partitionBy(*place, "literal", "literal_run"))))
    certain = F.col("literal") & ((F.size("item_slots") == 0) | (F.col("literal_windows") > WINDOWS_IN_A_ROW))
    runs = (hits.groupBy(*place, "run")
            .agg(F.size(F.collect_set("item_at")).alias("all"), F.size(F.collect_set(F.when(certain, F.col("item_at")))).alias("certain"),
                 F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")))
    consistent = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["item_slots"])))
    same = F.forall("pairs", lambda p: p["item_slots"] == p["slots"])
    aligned = (runs.withColumn("counted", F.when(consistent, F.col("all")).otherwise(F.col("certain"))).where("counted > 0")
               .groupBy(*place).agg(F.sum("counted").alias("matched"), F.min(same).alias("same")))
    return (aligned.where(F.col("matched") >= F.col("needed")).groupBy(F.col(key), F.col(item))
            .agg(F.max("matched").alias("matched_windows"), F.max("item_windows").alias("item_windows"), F.max("same").alias("same_values")))


def _items(benchmark: DataFrame, *columns: str) -> DataFrame:
    rows, number = numbered(benchmark.select(*columns))
    return rows.select(F.col(number).alias(ROW), *columns)


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id",
            stored: bool = False) -> DataFrame:
    """One row per document and item that it leaks: key, item, ``matched_windows`` of the best alignment, ``item_windows``
    and ``same_values`` (false where the question comes with other parameters). For ``stored`` see
    :func:`tradeloom.llm.shared.numbered`."""
    rows, number = numbered(docs.select(key, text), stored)
    docs, benchmark = rows.select(F.col(number).alias(ROW), key, text), _items(benchmark, item, text)
    found = written(leaking_rows(docs, benchmark, text), "leaks")
    names = benchmark.select(F.col(ROW).alias("item"), F.col(item).alias("_item"))
    # the leaks are looked up in the rows, which stay where they are
    few = F.broadcast(found) if found.count() <= BROADCAST_NUMBERS // 4 else found
    return (docs.select(ROW, key).join(few, ROW).join(names, "item").groupBy(F.col(key), F.col("_item").alias(item))
            .agg(F.max("matched_windows").alias("matched_windows"), F.max("item_windows").alias("item_windows"),
                 F.max("same_values").alias("same_values")))


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", stored: bool = False) -> DataFrame:
    """The rows that leak no item, with all their columns."""
    rows, number = numbered(docs, stored)
    narrow = rows.select(F.col(number).alias(ROW), text)
    leaking = written_alone(docs.sparkSession, lambda: leaking_rows(narrow, _items(benchmark, text), text).select(ROW).distinct(), "leaking")
    return without_rows(rows, number, leaking)
