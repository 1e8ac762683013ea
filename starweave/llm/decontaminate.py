"""Benchmark decontamination with a broadcast hash set of test n-grams. DataFrame functions only.

Benchmark items and documents are cut into the same words. Every 10 consecutive
words of an item are a window (an item of fewer words is one window). A small
two-probe bit table, made from the windows' first, middle and last words, lets
each document scan its own windows inside its row. It travels with the plan (a
function over an array cannot ask a subquery), so its size is bounded; of what
passes, a Bloom filter of whole windows, sized by their count and shipped beside the
plan, leaves the few that are looked up by hash in the window table, and a hit counts
only if the words are equal.
The window table is broadcast if its measured size allows it and joined by a
shuffle beyond that; the results are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.llm.common import save, table, unused, with_named, without
from starweave.operators.bloom import bloom_filter, may_hold, size_for

WINDOW = 10
BROADCAST_BYTES = 32 << 20
SLOTS, MAX_SLOTS = 1 << 17, 1 << 20  # bytes of the bit table that travels with the plan: 64 a window up to the first, else 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is (`lower` does just that where every character is ASCII)."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def benchmark_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, len, probe, gram, hash) of every window; items without words have none."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("len", F.least(F.size("w"), F.lit(size)))
    w = w.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("len"))))
    w = w.withColumn("gram", F.array_join(F.slice("w", F.col("at") + 1, F.col("len")), " "))
    return w.select("item_id", "len", probe(F.col("w"), F.col("at"), F.col("len")).alias("probe"), "gram", F.xxhash64("gram").alias("hash")).distinct()


def probe(w: Column, at: Column, size: Column) -> Column:
    return F.xxhash64(F.get(w, at), F.get(w, at + F.floor(size / 2).cast("int")), F.get(w, at + size - 1))


def _slot(h: Column, slots: int, second: bool) -> Column:
    return F.pmod(F.shiftright(h, 24) if second else h, F.lit(slots)).cast("int")


def table_slots(windows: int) -> int:
    slots = 1 << 12
    while slots < MAX_SLOTS and slots < max(16 * windows, min(64 * windows, SLOTS)):
        slots *= 2
    return slots


def _bit_table(windows: DataFrame, count: int) -> bytes:
    slots = table_slots(count)
    both = F.array(_slot(F.col("probe"), slots, False), _slot(F.col("probe"), slots, True))
    marks = bytearray(slots)
    for (i,) in windows.select(F.explode(both)).distinct().collect():  # at most MAX_SLOTS rows
        marks[i] = 1
    return bytes(marks)


def hits(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(row, id, key, n_words, n_hit, spans, items) for each row of ``docs`` (doc_id, text).

    row: number of the scanned row; key: hash of the text; spans: (at, len) of every window occurrence, in order;
    n_hit: words inside any of them; items: ids, as strings, of the items they
    belong to, in order. Items without an id mark words, but are not named.
    """
    found = save(benchmark_windows(items, size), "benchmark-windows")
    per_len = dict(found.groupBy("len").count().collect())  # at most `size` rows
    volume = found.agg(F.sum(F.octet_length("gram") + F.lit(64))).first()[0] or 0
    count = sum(per_len.values())
    bits = F.lit(_bit_table(found, count))
    slots = F.octet_length(bits)
    grams = found.select("hash", "gram", F.col("item_id").cast("string").alias("item"), F.lit(True).alias("hit"))
    if volume <= BROADCAST_BYTES:
        grams = F.broadcast(grams)

    def marked(i: Column, n: int, second: bool) -> Column:
        slot = _slot(probe(F.col("w"), i, F.lit(n)), slots, second)
        return F.substr(bits, slot + 1, F.lit(1)) == F.lit(b"\x01")

    def passing(n: int) -> Column:
        every = F.sequence(F.lit(0), F.size("w") - n)
        at = F.filter(F.when(F.size("w") >= n, every), lambda i: marked(i, n, False) & marked(i, n, True))
        return F.coalesce(F.transform(at, lambda i: F.struct(i.alias("at"), F.lit(n).alias("len"))), F.array().cast("array<struct<at:int,len:int>>"))

    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), words(F.col("text")).alias("w"))
    scan = base.select("row", "id", "key", "w", F.size("w").cast("long").alias("n_words"), F.explode_outer(F.concat(*[passing(n) for n in sorted(per_len) or [size]])).alias("span"))
    gram = F.when(F.col("span").isNotNull(), F.array_join(F.slice("w", F.col("span.at") + 1, F.col("span.len")), " "))
    scan = scan.select("row", "id", "key", "n_words", "span", gram.alias("gram"))
    if (size_bits := size_for(count)) is not None:  # else the join looks up all that passed
        held = bloom_filter(found, ["gram"], size_bits).scalar()
        scan = scan.withColumn("gram", F.when(may_hold(held, [F.col("gram")], size_bits), F.col("gram")))
    # rows without a window to look up get a hash of their own, so that a shuffle spreads them
    scan = scan.withColumn("hash", F.when(F.col("gram").isNull(), F.xxhash64("row")).otherwise(F.xxhash64("gram")))
    met = scan.join(grams, ["hash", "gram"], "left").groupBy("row", "id", "key", "n_words").agg(
        F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("span")))).alias("spans"),
        F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("item")))).alias("items"),
    )

    def cover(acc: Column, s: Column) -> Column:
        end = s["at"] + s["len"]
        return F.struct((acc["n"] + F.greatest(F.lit(0), end - F.greatest(s["at"], acc["end"]))).alias("n"), F.greatest(end, acc["end"]).alias("end"))

    covered = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), cover, lambda a: a["n"].cast("long"))
    return met.select("row", "id", "key", "n_words", covered.alias("n_hit"), "spans", "items")


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words inside ``spans``, each taken out with the separators behind it."""
    sep = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
    pieces = F.regexp_extract_all(text, F.lit(f"[^{sep}]+[{sep}]*|^[{sep}]+"), F.lit(0))
    lead = text.rlike(f"^[{sep}]").cast("int")  # the first piece then holds no word
    inside = lambda i: F.exists(spans, lambda s: (i - lead >= s["at"]) & (i - lead < s["at"] + s["len"]))
    return F.array_join(F.filter(pieces, lambda _, i: ~inside(i)), "")


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    """op6: one row for each row of ``docs``, repeated ones too. Null and empty texts have no words; an empty benchmark hits nothing."""
    found = hits(docs.select("doc_id", "text"), items.select("item_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def remove_spans(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with the words inside window occurrences cut out of ``text``; all other columns as they are."""
    found = hits(docs.select("doc_id", "text"), items.select("item_id", "text"), size).where("n_hit > 0")
    key, id_, cut = unused(docs, "text_key"), unused(docs, "hit_id"), unused(docs, "hit_spans")
    found = found.select(F.col("id").alias(id_), F.col("key").alias(key), F.col("spans").alias(cut)).dropDuplicates([id_, key])
    rows = with_named(docs, found, id_, key, cut)
    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(without_spans(F.col("text"), F.col(cut)))
    return rows.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a window of the benchmark go; the others stay as they are."""
    found = hits(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    gone = found.where("n_hit > 0").select(F.col("id").alias("gone_id"), F.col("key").alias("gone_key")).distinct()
    return without(docs, gone, "gone_id", "gone_key")
