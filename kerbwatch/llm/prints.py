"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

The shingles of ``width`` words are hashed once. The hash's high bits name one of ``BINS`` bins, and each bin keeps
its least hash. An empty bin takes the value of another: each bin has a fixed pseudo-random order of all bins,
and the first full one in that order is taken (optimal densification). The low ``BITS`` bits of every bin are
packed into hexadecimal digits. Two bins agree by chance once in ``2 ** BITS``; likeness is corrected for that.

Texts of fewer words than a shingle are one shingle; texts without words have one fixed fingerprint, so
equal texts always have equal fingerprints. A null text counts as empty. Everything is made within a row; the only
text that moves is that of a document's successor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbwatch.session import materialise

BINS, BITS, WIDTH = 128, 8, 5
#: Documents whose ids lie together, for finding each one's successor.
NEIGHBOURS = 256
_SIZE = 40  # bits of a shingle's hash that are used


def _bins(text: str) -> list[tuple[str, Column]]:
    """Steps from a text column to its least hash in each full bin: (column, expression), one after the other."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\s]+"), lambda w: w != "")
    hashes = F.transform(F.col("_words"), lambda w: F.xxhash64(w))
    n = F.size("_hashes")
    at = lambda i: F.get(F.col("_hashes"), i)
    shingles = F.transform(
        F.sequence(F.lit(0), F.greatest(n - WIDTH, F.lit(0))),
        lambda i: F.shiftrightunsigned(F.xxhash64(*(at(i + k) for k in range(WIDTH))), 64 - _SIZE))
    per_bin = 1 << (_SIZE - (BINS.bit_length() - 1))
    bin_of = lambda h: F.shiftright(h, per_bin.bit_length() - 1)
    ordered = F.array_sort(F.array_distinct("_shingles"))
    first = F.filter(F.col("_ordered"), lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(F.col("_ordered"), i - 1))))
    return [("_words", words), ("_hashes", hashes), ("_shingles", shingles), ("_ordered", ordered), ("_full", first)]


def fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of ``text`` as column ``name``."""
    rest = df.columns
    for column, value in _bins(text):
        df = df.withColumn(column, value)
        if column != "_words":
            df = df.drop({"_hashes": "_words", "_shingles": "_hashes", "_ordered": "_shingles", "_full": "_ordered"}[column])
    shift = _SIZE - (BINS.bit_length() - 1)
    df = df.withColumn("_held", F.map_from_arrays(F.transform("_full", lambda h: F.shiftright(h, shift).cast("int")), F.col("_full")))
    keys = F.map_keys("_held")
    # rank of a full bin j in bin i's order; j itself is the tie-break, so the choice is always the same
    rank = lambda i: F.transform(keys, lambda j: F.pmod(F.hash(i, j), F.lit(1 << 20)).cast("bigint") * BINS + j)
    chosen = lambda i: F.element_at("_held", (F.array_min(rank(i)) % BINS).cast("int"))
    # the value is hashed with the bin, so that bins with the same value do not agree by chance all together
    low = lambda i, h: F.lpad(F.lower(F.hex(F.xxhash64(h, i).bitwiseAND((1 << BITS) - 1))), BITS // 4, "0")
    packed = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)),
                         lambda i: low(i, F.coalesce(F.element_at("_held", i), chosen(i))))
    return df.withColumn(name, F.array_join(packed, "")).select(*rest, name)


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two fingerprints' shingle sets, from 0 to 1."""
    digits = BITS // 4
    same = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.substring(F.col(a), i * digits + 1, F.lit(digits))
                           == F.substring(F.col(b), i * digits + 1, F.lit(digits))))
    chance = 1.0 / (1 << BITS)
    return F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance))


def _lot(key: Column, kind: str, text_hash: Column) -> Column:
    """Lots in the order of the rows: null keys first, by the hash of their text, then keys by value."""
    if kind == "string":
        # the first six bytes as a number keep the order of text
        head = F.rpad(F.hex(F.substring(F.encode(key, "UTF-8"), 1, 6)), 12, "0")
        value = F.conv(head, 16, 10).cast("bigint")
    else:
        value = F.floor(key / NEIGHBOURS).cast("bigint")
    return F.coalesce(value, F.shiftright(text_hash, 43) - F.lit(1 << 61))


def successors(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, text, next_text: the row after each in ascending key, the first after the last.

    Null keys come first, by the hash of their text; equal keys go by their text. Keys are numbers or text. Rows with
    nearby keys are dealt together. The last of such a lot finds its successor by the next lot that has rows, which
    takes one small row for each lot, dealt in the same way once more.
    """
    kind = "string" if docs.schema[key].dataType.simpleString() == "string" else "number"
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    hashed = F.when(F.col("key").isNull(), F.xxhash64("text"))
    rows = rows.withColumn("first", hashed).withColumn("lot", _lot(F.col("key"), kind, F.col("first")))
    inside = Window.partitionBy("lot").orderBy("first", "key", "text")
    led = rows.select("*", F.lead(F.struct("key", "text")).over(inside).alias("next"))
    head = F.min_by(F.struct("key", "text"), F.struct("first", "key", "text")).alias("head")
    first = materialise(rows.groupBy("lot").agg(head), "lots")
    lots = first.select("lot", F.floor(F.col("lot") / NEIGHBOURS).cast("bigint").alias("area"))
    areas = lots.groupBy("area").agg(F.min("lot").alias("least"))
    least = areas.agg(F.min("least")).first()[0]
    # one row for 65,536 neighbouring keys
    after = areas.select("area", F.coalesce(F.lead("least").over(Window.orderBy("area")), F.lit(least)).alias("following"))
    ordered = lots.select("*", F.lead("lot").over(Window.partitionBy("area").orderBy("lot")).alias("near"))
    heads = ordered.join(after, "area").select("lot", F.coalesce("near", "following").alias("next_lot"))
    heads = heads.join(first.select(F.col("lot").alias("next_lot"), "head"), "next_lot").select("lot", "head")
    # the rows lie by lot already, so this moves the small side only
    both = led.join(heads, "lot").select("key", "text", F.coalesce("next", "head").alias("next"))
    return both.select("key", "text", F.col("next.text").alias("next_text"))


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, text, next_print and the text whose second half is the beginning of the next one's.

    own_print and next_print are hashes of the row's and the next row's text.
    """
    rows = successors(docs, key, text)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    changed = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    own, following = (F.concat_ws("-", F.hex(F.xxhash64(c)), F.hex(F.xxhash64(F.lit(1), c))) for c in ("text", "next_text"))
    return rows.select("key", own.alias("own_print"), following.alias("next_print"), n.cast("bigint").alias("n_chars"), "text",
                       changed.alias("edited"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    Null texts count as empty. Null, repeated and textual keys are put in order as ``successors`` says; rows that repeat
    follow each other. An empty table gives no rows; other columns are not read.
    """
    rows = edited(docs, key, text).withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
    rows = fingerprint(rows, "text", "fingerprint").drop("text")
    rows = fingerprint(rows, "edited", "edited_fingerprint").drop("edited")
    rows = materialise(rows, "fingerprints")
    # a fingerprint depends on the text alone; a text that follows very many rows is split by the adaptive skew join
    following = rows.groupBy(F.col("own_print").alias("next_print")).agg(F.min("fingerprint").alias("next_fingerprint"))
    rows = rows.join(following, "next_print")
    return rows.select(F.col("key").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                       likeness("fingerprint", "next_fingerprint").alias("near_next"))
