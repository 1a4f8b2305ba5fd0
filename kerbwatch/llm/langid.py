"""Language identification by interpolated Kneser-Ney character models.

A model is the 4-grams of one language's training texts (letters lower-cased, everything else a space) with
their counts, gathered over all training rows: tasks add up what they read before anything is shuffled. From
them follow, in Spark and over all grams, the continuation counts, context totals and discounts of every order. Codes
have 64 bits (four 16-bit characters; characters beyond are hashed to 16 bits).

A model with at most ``PER_LANGUAGE`` grams of an order (and ``ENTRIES`` values in all languages together) goes to every
task as sorted arrays, and texts are scored in one pass. Of a larger one only the commonest grams and contexts go to the
tasks, each with its values in all languages; the whole model stays a table. A text's grams that these do not settle are
looked up there by joins, so every text is scored with the whole model, whatever its size.

A text belongs to the language with the lowest cross-entropy per character. It is rejected if that lies above
what the language's own texts have: mean plus ``MARGIN`` nats, or for short texts plus ``Z`` standard errors. Mean and
deviation are measured by scoring every training text with the finished model.

Null texts and texts without a letter are ``und`` with score 0 and rejected. Null languages are not learned
from; with nothing to learn from every text is ``und``. Ties go to the language first in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbwatch.llm.common import look_up, raw
from kerbwatch.session import materialise, ship_package

ENTRIES = 1 << 21
PER_LANGUAGE = 1 << 18
#: The fewest training texts of a language that are enough to set its limit.
FEWEST = 20
MARGIN, Z = 1.0, 8.0
#: Characters handled together, and distinct 4-grams a task holds before it passes them on.
BLOCK, HELD = 1 << 20, 1 << 20
#: Characters that count as independent evidence at most, for the confidence.
EVIDENCE = 40
_SPACE = np.uint64(32)


def alphabet() -> np.ndarray:
    """For every code point its lower-case 16-bit code, or a space if it is no letter."""
    out = np.full(0x110000, 32, np.uint16)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            low = ord(low) if len(low) == 1 else c
            out[c] = low if low < 0xD800 else 0xE000 + low % 0x1F00
    return out


def symbols(text: bytes | None, table: np.ndarray) -> np.ndarray:
    """Codes of a text with runs of other characters as one space and a space at each end; none without letters."""
    if not text:
        return np.zeros(0, np.uint64)
    c = table[np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)]
    c = c[np.r_[c[:1] != 32, (c[1:] != 32) | (c[:-1] != 32)]]
    if not (c != 32).any():
        return np.zeros(0, np.uint64)
    c = c[:-1] if c[-1] == 32 else c
    return np.r_[_SPACE, c.astype(np.uint64), _SPACE]


def grams(c: np.ndarray) -> np.ndarray:
    """Code of the 4-gram that ends at each symbol but the first; the text is led by spaces."""
    p = np.r_[_SPACE, _SPACE, c]
    return (p[:-3] << np.uint64(48)) | (p[1:-2] << np.uint64(32)) | (p[2:-1] << np.uint64(16)) | p[3:]


def counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, gram, n over all rows."""
    ship_package(docs.sparkSession)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = alphabet()
        held: dict[str, list[np.ndarray]] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        size: dict[str, int] = {}

        def fold(language):
            new, times = np.unique(np.concatenate(held.pop(language)), return_counts=True)
            if language in sums:
                old, had = sums[language]
                both, at = np.unique(np.r_[old, new], return_inverse=True)
                sums[language] = both, np.bincount(at, np.r_[had, times]).astype(np.int64)
            else:
                sums[language] = new, times.astype(np.int64)
            size[language] = 0

        def passed_on():
            for language in list(sums):
                code, times = sums.pop(language)
                for lo in range(0, len(code), 10_000):
                    part = code[lo:lo + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([language] * len(part)), pa.array(part.view(np.int64)), pa.array(times[lo:lo + 10_000])],
                        names=["lang", "gram", "n"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                piece = batch.slice(lo, 256)
                for value, language in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    c = symbols(value, table)
                    if len(c):
                        held.setdefault(language, []).append(grams(c))
                        size[language] = size.get(language, 0) + len(c)
                        if size[language] >= BLOCK:
                            fold(language)
            if sum(len(a) for a, _ in sums.values()) > HELD:
                yield from passed_on()
        for language in list(held):
            fold(language)
        yield from passed_on()

    found = docs.where(F.col(lang).isNotNull()).select(raw(text).alias("_raw"), F.col(lang).cast("string").alias("lang"))
    return found.mapInArrow(body, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


_ORDERS = (1, 2, 3, 4)
_LOW = {order: (1 << 16 * order) - 1 for order in _ORDERS}


def levels(found: DataFrame) -> DataFrame:
    """lang, order, gram, c, total and kinds for the grams of every order: the count (of shorter ones, how many different
    characters precede it), and the sum and number of the counts in its context. ``found`` has lang, gram and n."""
    parts, now = [], found.select("lang", "gram", F.col("n").alias("c"))
    for order in reversed(_ORDERS):
        if order < 4:
            # the characters before a gram are as many as the longer grams that end in it
            now = now.groupBy("lang", F.col("gram").bitwiseAND(_LOW[order]).alias("gram")).agg(F.count("*").alias("c"))
        now = materialise(now, "character-level")
        context = F.shiftrightunsigned("gram", 16).alias("context")
        sums = now.groupBy("lang", context).agg(F.sum("c").alias("total"), F.count("*").alias("kinds"))
        both = now.select("lang", "gram", "c", context).join(sums, ["lang", "context"])
        parts.append(both.select("lang", F.lit(order).alias("order"), "gram", "c", "total", "kinds"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return materialise(out, "character-levels")


def commonest(table: DataFrame, most: int) -> DataFrame:
    """The commonest codes of each part and order, as many as there are above the count at which ``most`` would be passed."""
    group = ["part", "order"]
    by_count = table.groupBy(*group, "n").agg(F.count("*").alias("codes"))
    upto = F.sum("codes").over(Window.partitionBy(*group).orderBy(F.desc("n")))
    least = by_count.withColumn("upto", upto).where(F.col("upto") <= most).groupBy(*group).agg(F.min("n").alias("least"))
    return table.join(F.broadcast(least), group).where("n >= least")


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", entries: int = ENTRIES, per_language: int = PER_LANGUAGE) -> dict:
    """Models of all languages in ``docs``. ``entries`` and ``per_language`` bound what tasks hold, not the model."""
    found = materialise(counts(docs, text, lang), "character-grams")
    languages = sorted(r[0] for r in found.select("lang").distinct().collect())
    if not languages:
        return {"languages": []}
    table = levels(found)
    c = F.col("c")
    facts = table.groupBy("lang", "order").agg(F.count_if(c == 1).alias("once"), F.count_if(c == 2).alias("twice")).collect()
    discount = {(r["lang"], r["order"]): _discount(r["once"], r["twice"]) for r in facts}
    kinds = dict(table.select("order", "gram").distinct().groupBy("order").count().collect())
    most = max(1, min(per_language, entries // len(languages)))
    if max(kinds.values()) > most:
        model = _in_tables(table, languages, discount, kinds[1] + 1, most)
    else:
        model = _in_arrays(table, languages, discount, kinds[1] + 1)
    return _calibrated(docs, {"languages": languages, **model}, text, lang)


def _in_arrays(table: DataFrame, languages: list[str], discount: dict, size: int) -> dict:
    """The whole model as arrays."""
    number = F.array_position(F.array(*(F.lit(x) for x in languages)), F.col("lang")).cast("int") - 1
    arrays: list[list[tuple]] = [[] for _ in languages]
    for order in _ORDERS:
        data = table.where(F.col("order") == order).select(number.alias("k"), "gram", "c", "total", "kinds").toArrow()
        column = {n: data.column(n).to_numpy() for n in data.column_names}
        del data
        for k, language in enumerate(languages):
            at = np.flatnonzero(column["k"] == k)
            at = at[np.argsort(column["gram"][at].view(np.uint64))]
            arrays[k].append((column["gram"][at].view(np.uint64), *(column[n][at].astype(np.float64) for n in ("c", "total", "kinds")), discount[language, order]))
        del column
    return union([interpolate(a, size) for a in arrays])


def _in_tables(table: DataFrame, languages: list[str], discount: dict, size: int, most: int) -> dict:
    """The whole model as a table (part, order, code, n, and by language the log probability of a gram or the log back-off
    weight of a context), its ``most`` commonest codes as arrays, and in ``open`` the arrays that are not whole."""
    spark, count = table.sparkSession, len(languages)
    rates = spark.createDataFrame([(x, k, order, discount[x, order]) for k, x in enumerate(languages) for order in _ORDERS],
                                  "lang string, k int, order int, d double")
    every = table.join(F.broadcast(rates), ["lang", "order"]).withColumn("weight", F.col("d") * F.col("kinds") / F.col("total"))
    parts: list[DataFrame] = []
    for order in _ORDERS:
        own = (F.col("c") - F.col("d")) / F.col("total")
        now = every.where(F.col("order") == order).select("order", "k", "gram", "c", "weight", own.alias("own"))
        if order == 1:
            now = now.withColumn("below", F.lit(1 / size))
        else:
            shorter = parts[-1].select("k", F.col("gram").alias("shorter"), F.exp("logp").alias("below"))
            now = now.withColumn("shorter", F.col("gram").bitwiseAND(_LOW[order - 1])).join(shorter, ["k", "shorter"])
        p = F.col("own") + F.col("weight") * F.col("below")
        parts.append(materialise(now.select("order", "k", "gram", "c", "weight", F.log(p).alias("logp")), "character-probabilities"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    contexts = whole.groupBy("order", F.shiftrightunsigned("gram", 16).alias("code"), "k").agg(
        F.sum("c").alias("c"), F.log(F.max("weight")).alias("value"))
    grams = whole.select("order", F.col("gram").alias("code"), "k", "c", F.col("logp").alias("value"))
    both = grams.withColumn("part", F.lit("gram")).unionByName(contexts.withColumn("part", F.lit("context")))
    values = F.map_from_entries(F.collect_list(F.struct("k", "value")))
    known = materialise(both.groupBy("part", "order", "code").agg(F.sum("c").alias("n"), values.alias("values")), "character-model")

    top = materialise(commonest(known, most).select("part", "order", "code", F.explode("values").alias("k", "value")), "character-commonest")
    all_of = {(r["part"], r["order"]): r["count"] for r in known.groupBy("part", "order").count().collect()}
    out: dict = {"unknown": np.full(count, -np.log(size)), "known": known, "open": set()}
    for name, value in (("gram", "logp"), ("context", "back")):
        for order in _ORDERS:
            data = top.where((F.col("part") == name) & (F.col("order") == order)).select("code", "k", "value").toArrow()
            code, k, v = (data.column(n).to_numpy() for n in data.column_names)
            code, at = np.unique(code.view(np.uint64), return_inverse=True)
            table_of = np.full((len(code), count), np.nan, np.float32)
            table_of[at, k] = v
            out[f"{name}{order}"], out[f"{value}{order}"] = code, table_of
            if len(code) < all_of[name, order]:
                out["open"].add(f"{name}{order}")
    n, logp = F.col("c"), F.col("logp")
    own = {r["k"]: r for r in parts[3].groupBy("k").agg(
        (F.sum(n * logp) / F.sum(n)).alias("mean"), (F.sum(n * logp * logp) / F.sum(n)).alias("square")).collect()}
    out["mean"] = np.array([-own[k]["mean"] for k in range(count)])
    out["deviation"] = np.sqrt(np.maximum([own[k]["square"] - own[k]["mean"] ** 2 for k in range(count)], 1e-6))
    return out


def _discount(once: float, twice: float) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once and twice else 0.5


def kneser_ney(code: np.ndarray, n: np.ndarray) -> dict:
    """Model of one language from its sorted 4-gram codes and counts, with nothing left out."""
    chain: list[tuple[np.ndarray, np.ndarray]] = [(code, n.astype(float))]
    for order in (3, 2, 1):
        chain.insert(0, tuple(x.astype(t) for x, t in zip(np.unique(chain[0][0] & np.uint64(_LOW[order]), return_counts=True), (np.uint64, float))))
    arrays = []
    for gram, c in chain:
        _, at = np.unique(gram >> np.uint64(16), return_inverse=True)
        arrays.append((gram, c, np.bincount(at, c)[at], np.bincount(at)[at].astype(float), _discount((c == 1).sum(), (c == 2).sum())))
    return interpolate(arrays, len(chain[0][0]) + 1)


def interpolate(arrays: list[tuple], size: int) -> dict:
    """Interpolated model from (gram, c, total, kinds, discount) of each order, grams sorted: log probability of every gram, log
    back-off weight of every context, and mean and deviation of the log probability of its own 4-grams. ``size`` is
    the number of characters in all languages: one that a language has not seen gets the same share in each."""
    out: dict = {"unknown": -np.log(size)}
    lower = np.zeros(0)
    for order, (gram, c, total, kinds, d) in zip(_ORDERS, arrays):
        back = d * kinds / total
        below = np.exp(_shorter(out, gram & np.uint64(_LOW[order - 1]), order - 1)) if order > 1 else np.full(len(gram), 1 / size)
        lower = (c - d) / total + back * below
        context, first = np.unique(gram >> np.uint64(16), return_index=True)
        out[f"gram{order}"], out[f"logp{order}"] = gram, np.log(lower)
        out[f"context{order}"], out[f"back{order}"] = context, np.log(back[first])
    n = arrays[3][1]
    weight = n / max(n.sum(), 1)
    out["mean"] = float(-(weight * out["logp4"]).sum()) if len(n) else 0.0
    out["deviation"] = float(np.sqrt(max((weight * out["logp4"] ** 2).sum() - out["mean"] ** 2, 1e-6)))
    return out


def _shorter(model: dict, code: np.ndarray, top: int) -> np.ndarray:
    """Log probability of codes of order ``top``: of the gram itself, or of its shorter one with the back-off weight."""
    p = np.full(len(code), model["unknown"])
    for order in range(1, top + 1):
        key = code & np.uint64(_LOW[order])
        seen, back = (_found(model[n], model[v], k) for n, v, k in ((f"gram{order}", f"logp{order}", key),
                                                                    (f"context{order}", f"back{order}", key >> np.uint64(16))))
        p = np.where(np.isnan(seen), p + np.nan_to_num(back), seen)
    return p


def _found(known: np.ndarray, value: np.ndarray, key: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.full(len(key), np.nan)
    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
    return np.where(known[at] == key, value[at], np.nan)


def _calibrated(docs: DataFrame, model: dict, text: str, lang: str) -> dict:
    """``model`` with mean and deviation of texts of each language, where there are enough of them."""
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), raw(text).alias("_raw"))
    rows = rows.where("_raw IS NOT NULL")

    def made(columns, ce, n, m):
        number = {name: k for k, name in enumerate(m["languages"])}
        found = [(name, ce[i, number[name]], int(n[i])) for i, name in enumerate(columns[0].to_pylist()) if n[i] and name in number]
        if found:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["lang", "ce", "chars"])

    scored, shared = _over_texts(rows, model, made, "lang string, ce double, chars bigint")
    scored = materialise(scored, "calibration")
    shared.destroy()
    mean = scored.groupBy("lang").agg((F.sum(F.col("ce") * F.col("chars")) / F.sum("chars")).alias("mean"))
    off = F.col("chars") * (F.col("ce") - F.col("mean")) ** 2
    found = scored.join(F.broadcast(mean), "lang").groupBy("lang").agg(
        F.first("mean").alias("mean"), F.sqrt(F.avg(off)).alias("deviation"), F.count("*").alias("texts")).collect()
    for r in found:
        k = model["languages"].index(r["lang"])
        if r["texts"] >= FEWEST:
            model["mean"][k], model["deviation"][k] = r["mean"], max(r["deviation"], 1e-3)
        else:  # the model's own grams flatter it, so the larger one counts
            model["mean"][k] = max(model["mean"][k], r["mean"])
    return model


def union(models: list[dict]) -> dict:
    """The models' arrays side by side: one sorted code array for each order, a column for each language."""
    out: dict = {"mean": np.array([m["mean"] for m in models]), "deviation": np.array([m["deviation"] for m in models]),
                 "unknown": np.array([m["unknown"] for m in models])}
    for order in (1, 2, 3, 4):
        for name, value in (("gram", "logp"), ("context", "back")):
            code = np.unique(np.concatenate([m[f"{name}{order}"] for m in models]))
            values = np.full((len(code), len(models)), np.nan, np.float32)
            for k, m in enumerate(models):
                values[np.searchsorted(code, m[f"{name}{order}"]), k] = m[f"{value}{order}"]
            out[f"{name}{order}"], out[f"{value}{order}"] = code, values
    return out


def _look(known: np.ndarray, values: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of each key in each language, and whether the key is there."""
    if not len(known):
        return np.full((len(key), values.shape[1]), np.nan, np.float32), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
    there = known[at] == key
    return np.where(there[:, None], values[at], np.nan), there


def _looked_up(model: dict, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of each distinct 4-gram code's last character in each language, and whether the model's arrays are
    enough for it: nothing that they lack could change it."""
    p = np.broadcast_to(model["unknown"], (len(code), len(model["unknown"]))).astype(np.float32)
    settled, lacking = np.ones(len(code), bool), model.get("open", ())
    for order in _ORDERS:
        key = code & np.uint64(_LOW[order])
        seen, there = _look(model[f"gram{order}"], model[f"logp{order}"], key)
        back, context = _look(model[f"context{order}"], model[f"back{order}"], key >> np.uint64(16))
        unseen = np.isnan(seen)
        p = np.where(unseen, p + np.nan_to_num(back), seen)  # an unseen context leaves all to the shorter one
        if lacking:
            there, context = there | (f"gram{order}" not in lacking), context | (f"context{order}" not in lacking)
            settled = there & (~unseen.any(1) | (context & settled))
    return p, settled


def log_probability(model: dict, code: np.ndarray) -> np.ndarray:
    """Log probability of each distinct 4-gram code's last character in each language, from the arrays of the model."""
    return _looked_up(model, code)[0]


def _sums(texts: list[bytes | None], m: dict, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[tuple]]]:
    """Log probability of each text in each language without the grams that the arrays do not settle, the number of
    characters, and those grams with their times."""
    total, n = np.zeros((len(texts), max(1, len(m["languages"])))), np.zeros(len(texts), np.int64)
    left: list[list[tuple]] = [[] for _ in texts]
    held, which, size = [], [], 0

    def settle():
        code, at = np.unique(np.concatenate(held), return_inverse=True)
        p, settled = _looked_up(m, code)
        cuts = np.cumsum([0, *map(len, held)])
        if not settled.all():
            p[~settled] = 0
            for i, lo, hi in zip(which, cuts, cuts[1:]):
                part, times = np.unique(at[lo:hi], return_counts=True)
                part, times = part[~settled[part]], times[~settled[part]]
                if len(part):
                    left[i].append((code[part].view(np.int64), times))
        for k in range(len(m["languages"])):
            np.add.at(total[:, k], which, np.add.reduceat(p[:, k].astype(np.float64)[at], cuts[:-1]))

    for i, value in enumerate(texts if m["languages"] else ()):
        g = grams(c) if len(c := symbols(value, table)) else ()
        n[i] = len(g)
        for k in range(0, len(g), BLOCK):
            if held and size + len(g[k:k + BLOCK]) > BLOCK:
                settle()
                held, which, size = [], [], 0
            held.append(g[k:k + BLOCK])
            which.append(i)
            size += len(held[-1])
    if held:
        settle()
    return total, n, left


def _cross_entropies(texts: list[bytes | None], m: dict, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per character of each text in each language, and the number of characters."""
    total, n, _ = _sums(texts, m, table)
    return -total / np.maximum(n, 1)[:, None], n


def _resolved(needed: DataFrame, model: dict) -> DataFrame:
    """``needed`` (gram, size) with ``p``: the log probability in each language, from the whole model."""
    p = F.array(*(F.lit(float(x)) for x in model["unknown"]))
    before = None
    for order in _ORDERS:
        now = needed if order == 4 else needed.select(F.col("gram").bitwiseAND(_LOW[order]).alias("gram")).distinct()
        known = model["known"].where(F.col("order") == order)
        seen = known.where("part = 'gram'").select(F.col("code").alias("gram"), F.col("values").alias("seen"))
        back = known.where("part = 'context'").select(F.col("code").alias("context"), F.col("values").alias("back"))
        now = now.withColumn("context", F.shiftrightunsigned("gram", 16)).join(seen, "gram", "left").join(back, "context", "left")
        if before is None:
            now = now.withColumn("below", p)
        else:
            now = now.withColumn("shorter", F.col("gram").bitwiseAND(_LOW[order - 1])).join(before, "shorter")
        value = F.transform("below", lambda x, k: F.coalesce(
            F.try_element_at("seen", k), x + F.coalesce(F.try_element_at("back", k), F.lit(0.0))))
        if order == 4:
            return materialise(now.select("gram", "size", value.alias("p")), "character-needed")
        before = materialise(now.select(F.col("gram").alias("shorter"), value.alias("below")), "character-shorter")


def _with_sums(rows: DataFrame, model: dict, shared) -> DataFrame:
    """``rows`` with ``_sum`` and ``_n`` for the text in the last column, which goes; grams that are not settled by the
    arrays are joined with the whole model."""
    names, count = rows.columns[:-1], len(model["languages"])

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, table = shared.value, alphabet()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                piece = batch.slice(lo, 512)
                total, n, left = _sums(piece.column(piece.num_columns - 1).to_pylist(), m, table)
                joined = [[np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 2 for parts in left]
                cuts = pa.array(np.cumsum([0, *(len(g) for g, _ in joined)]), pa.int32())
                lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate([x[j] for x in joined]), pa.int64())) for j in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[:-1], pa.array(list(total), pa.list_(pa.float64())), pa.array(n), *lists],
                    names=[*names, "_sum", "_n", "_gram", "_times"])

    more = T._parse_datatype_string("_sum array<double>, _n bigint, _gram array<bigint>, _times array<bigint>")
    held = rows.mapInArrow(body, T.StructType([*rows.schema.fields[:-1], *more.fields]))
    held = materialise(held.withColumn("_row", F.monotonically_increasing_id()), "character-open")
    each = held.select("_row", F.explode(F.arrays_zip("_gram", "_times")).alias("o")).select("_row", F.col("o._gram").alias("gram"), F.col("o._times").alias("times"))
    needed = materialise(each.groupBy("gram").agg(F.count("*").alias("size")), "character-distinct")
    total = needed.agg(F.sum("size")).first()[0] or 0
    found = look_up(each, _resolved(needed, model), ["gram"], "size", total)
    more = found.groupBy("_row").agg(F.array(*(F.sum(F.col("times") * F.get("p", F.lit(k))) for k in range(count))).alias("_more"))
    both = held.join(more, "_row", "left").withColumn("_sum", F.coalesce(F.zip_with("_sum", "_more", lambda x, y: x + y), "_sum"))
    return both.select(*(F.col(f"`{c}`") for c in names), "_sum", "_n")


def _over_texts(rows: DataFrame, model: dict, make, schema) -> tuple[DataFrame, Broadcast]:
    """``make(columns, cross-entropies, characters, model)`` of pieces of ``rows``, whose last column has the texts, and
    the model as the tasks hold it."""
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast({k: v for k, v in model.items() if k != "known"})
    whole = not model.get("open")
    if not whole:
        rows = _with_sums(rows, model, shared)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, table = shared.value, alphabet() if whole else None
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                columns = batch.slice(lo, 512).columns
                if whole:
                    ce, n = _cross_entropies(columns.pop().to_pylist(), m, table)
                else:
                    n = columns.pop().to_numpy()
                    ce = -np.array(columns.pop().to_pylist()).reshape(len(n), -1) / np.maximum(n, 1)[:, None]
                if (out := make(columns, ce, n, m)) is not None:
                    yield out

    return rows.mapInArrow(body, schema), shared


def _judge(ce: np.ndarray, n: np.ndarray, m: dict, margin: float) -> dict:
    """Language, confidence, cross-entropy and rejection of each text."""
    languages = m["languages"]
    best = ce.argmin(1)
    own = ce[np.arange(len(n)), best]
    gap = (ce - own[:, None]) * np.minimum(n, EVIDENCE)[:, None]
    some = n > 0
    limit = np.zeros(len(n))
    if languages:
        limit = m["mean"][best] + np.maximum(margin, Z * m["deviation"][best] / np.sqrt(np.maximum(n, 1)))
    return {"language": [languages[b] if s else "und" for b, s in zip(best, some)], "some": some, "cross_entropy": own,
            "score": np.where(some, 1 / np.exp(-gap).sum(1), 0.0), "rejected": ~some | (own > limit)}


def predict(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``key``, lang_pred, score, cross_entropy (null for ``und``) and rejected for every row of ``docs``."""
    kind = docs.schema[key].dataType.simpleString()

    def made(columns, ce, n, m):
        j = _judge(ce, n, m, margin)
        return pa.RecordBatch.from_arrays([
            columns[0], pa.array(j["language"], pa.string()), pa.array(j["score"]),
            pa.array(j["cross_entropy"], mask=~j["some"]), pa.array(j["rejected"])],
            names=[key, "lang_pred", "score", "cross_entropy", "rejected"])

    schema = f"`{key}` {kind}, lang_pred string, score double, cross_entropy double, rejected boolean"
    return _over_texts(docs.select(F.col(key), raw(text).alias("_raw")), model, made, schema)[0]


def keep(docs: DataFrame, model: dict, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns as they were."""
    names = docs.columns

    def made(columns, ce, n, m):
        return pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(~_judge(ce, n, m, margin)["rejected"]))

    columns = [F.col(f"`{c}`") for c in names]
    return _over_texts(docs.select(*columns, raw(F.col(f"`{text}`")).alias("_raw")), model, made, docs.schema)[0]
