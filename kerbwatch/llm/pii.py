"""Personal data: base patterns, plus candidates that boosted trees accept; DataFrame functions only.

The base kinds are stated patterns with a check (parts of an address, Luhn, number of digits); their spans always
stay. High-recall generators propose further, overlapping spans: digit groups with any separators, and addresses
spelled with "at" and "dot". Gradient-boosted trees (Spark ML) judge a candidate by its format and the words before it. They
learn from all documents; examples with the same features count as one with a weight. Examples for are base spans written in forms that no base pattern
finds (spelled out, without plus, other separators), within the words around them; examples against are numbers that fail
Luhn, dates, amounts and ids. Numbers without a valid kind are never taken, and real candidates that are neither are
not learned from. Each kind has its own threshold, calibrated on its examples: the least score from which on at least
``PRECISION`` of them are right. The trees become one SQL expression, so scoring stays in the row.

Starts and ends count code points, ends exclusive. A null text counts as empty and has no spans; rows are judged one by one, so
repeated rows and equal ids do no harm. Without examples or with one class only there is no model
and only base spans are found. The patterns are the stated ones with possessive repeats and a start that
cannot lie inside a run. They find the same matches in linear time, and repeat single characters only, which the
regular expressions of the JVM do without recursion.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbwatch.session import materialise

PRECISION = 0.98
TREES, DEPTH = 8, 3
KINDS = ("email", "ip", "card", "phone")
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@"
             r"(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])(?:(?!\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:(?![\x20-](?![0-9]))[0-9\x20-])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
DIGITS = r"(?:\G|(?<![0-9+(]))[+(]?[0-9][0-9().\x20/-]{5,30}[0-9]"
SPELLED = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|at)\x20?[A-Za-z0-9-]{1,64}+\x20?"
           r"(?:\(dot\)|\[dot\]|dot)\x20?[A-Za-z]{2,10}+")
_NEAR = 24
_BLOCK = 64
FEATURES = ("digits", "marks", "size", "plus", "parens", "dots", "spelled", "word", "group", "cued", "luhn", "date")
DATE = r"^(?:(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2})(?![0-9])"
SPAN = "array<struct<a:int,b:int,m:string>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    return {"email": F.lit(True), "ip": m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
            "card": F.when(n.between(13, 19), F.call_function("luhn_check", _digits(m))).otherwise(False), "phone": n.between(9, 15)}[kind]


def _checked(kind: str):
    return lambda s: _valid(kind, s["m"])


def _matches(df: DataFrame, text: str, pattern: str, name: str, only: Column | None = None) -> DataFrame:
    """``df`` with all matches of a pattern as spans. Places are sums of the lengths before, added up in blocks."""
    p = F.lit(pattern)
    found, parts = F.regexp_extract_all(F.col(text), p, F.lit(0)), F.split(F.col(text), pattern, -1)
    if only is not None:
        found = F.when(only, found).otherwise(F.array().cast("array<string>"))
    df = df.withColumn("_m", found)
    df = df.withColumn("_p", F.when(F.size("_m") > 0, parts).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("_d", F.zip_with("_p", "_m", lambda x, y: F.length(x) + F.coalesce(F.length(y), F.lit(0))))
    add = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    df = df.withColumn("_s", F.transform(F.sequence(F.lit(0), F.floor(F.size("_d") / _BLOCK).cast("int")),
                                         lambda k: add(F.slice(F.col("_d"), k * _BLOCK + 1, F.lit(_BLOCK)))))
    df = df.withColumn("_o", F.transform(F.sequence(F.lit(0), F.size("_s") - 1), lambda k: add(F.slice(F.col("_s"), F.lit(1), k))))

    # each column is named twice below: what a function names once, the planner would put into it and redo for each match
    df = df.withColumn("_l", F.transform("_p", F.length))

    def span(m, i):
        k = F.floor(i / _BLOCK).cast("int")
        whole = F.when(F.size("_o") >= 0, F.get("_o", k))
        part = F.when(F.size("_d") >= 0, add(F.slice(F.col("_d"), k * _BLOCK + 1, i - k * _BLOCK)))
        a = whole + part + F.when(F.size("_l") >= 0, F.get("_l", i))
        return F.struct(a.cast("int").alias("a"), (a + F.length(m)).cast("int").alias("b"), m.alias("m"))

    return df.withColumn(name, F.transform("_m", span)).drop("_m", "_p", "_d", "_s", "_o", "_l")


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with an array of spans for each base kind."""
    for kind in KINDS:
        only = F.contains(F.col(text), F.lit("@" if kind == "email" else "+")) if kind in ("email", "phone") else None
        df = _matches(df, text, PATTERN[kind], f"_{kind}", only)
        df = df.withColumn(f"_{kind}", F.filter(f"_{kind}", _checked(kind)))
    return df


def _candidates(df: DataFrame, text: str) -> DataFrame:
    """``df`` with further candidates ``_more``: span, features, and whether a base span overlaps."""
    df = _matches(df, text, DIGITS, "_groups")
    spelled = F.contains(F.col(text), F.lit("dot")) & F.contains(F.col(text), F.lit("at"))
    df = _matches(df, text, SPELLED, "_spelled", spelled)
    df = df.withColumn("_base", F.concat(*(f"_{k}" for k in KINDS)))
    df = df.withColumn("_wide", F.concat("_groups", "_spelled"))
    count = lambda m, chars: (F.length(m) - F.length(F.regexp_replace(m, chars, ""))).cast("double")

    def look(s):
        m = s["m"]
        before = F.lower(F.substring(F.col(text), F.greatest(s["a"] - _NEAR + 1, F.lit(1)), F.least(s["a"], F.lit(_NEAR))))
        return F.struct(
            s["a"].alias("a"), s["b"].alias("b"), m.alias("m"), count(m, "[0-9]").alias("digits"), count(m, "[-\\x20/]").alias("marks"),
            F.length(m).cast("double").alias("size"), m.startswith("+").cast("double").alias("plus"), count(m, "[()]").alias("parens"),
            count(m, "[.]").alias("dots"), m.rlike("[A-Za-z]").cast("double").alias("spelled"),
            before.rlike("[a-z0-9]$").cast("double").alias("word"),
            F.length(F.regexp_extract(m, "([0-9]+)$", 1)).cast("double").alias("group"),
            before.rlike("tel|phone|call|fax|mobil|mail|contact|card|visa|konto|carte|tarjeta|addr|server|host").cast("double").alias("cued"),
            _valid("card", m).cast("double").alias("luhn"), m.rlike(DATE).cast("double").alias("date"),
            # named twice, as above
            F.when(F.size("_base") > 0, F.exists("_base", lambda b: (b["a"] < s["b"]) & (s["a"] < b["b"]))).otherwise(False).alias("known"))

    return df.withColumn("_more", F.transform("_wide", look)).drop("_groups", "_spelled", "_wide", "_base")


def _tree(node, value: Column) -> Column:
    """One tree as a SQL expression over a candidate's struct."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    left, right = _tree(node.leftChild(), value), _tree(node.rightChild(), value)
    return F.when(value[FEATURES[split.featureIndex()]] <= float(split.threshold()), left).otherwise(right)


def _kind(c: Column) -> Column:
    """The kind that a candidate can be, or null."""
    return (F.when(c["spelled"] > 0, "email").when(c["luhn"] > 0, "card")
            .when(c["digits"].between(9, 15), "phone"))


def _forms(kind: str, m: Column) -> list[Column]:
    """A base span in forms that the base patterns do not find."""
    d = _digits(m)
    if kind == "email":
        plain = m.rlike(r"^[^@]+@[A-Za-z0-9-]+[.][A-Za-z]{2,10}$")
        parts = [F.regexp_extract(m, r"^([^@]+)@([^.]+)[.](.+)$", i) for i in (1, 2, 3)]
        return [F.when(plain, F.concat(parts[0], F.lit(at), parts[1], F.lit(dot), parts[2]))
                for at, dot in ((" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "))]
    if kind == "phone":
        bare = F.regexp_replace(m, r"^[+]", "")
        return [bare, d, *(F.regexp_replace(bare, r"[\x20().-]+", sep) for sep in ("-", ".", " ", "/"))]
    if kind == "card":
        return [F.regexp_replace(d, "([0-9]{4})(?=[0-9])", f"$1{sep}") for sep in ("/", ".")]
    return []


def _numbers(m: Column, card: bool) -> list[Column]:
    """Numbers that are no personal data, made from a span: dates, amounts, ids, and cards that fail Luhn."""
    of = lambda seed, lo, n: (F.pmod(F.xxhash64(m, F.lit(seed)), F.lit(n)) + lo).cast("string")
    two = lambda seed, n: F.lpad(of(seed, 1, n), 2, "0")
    year, month, day = of(1, 1970, 60), two(2, 12), two(3, 28)
    out = [F.concat_ws("-", year, month, day), F.concat_ws("/", day, month, year), F.concat_ws(".", day, month, year),
           F.concat(F.concat_ws("-", year, month, day), F.lit(" "), two(4, 23)), F.concat(of(5, 10**8, 9 * 10**8), F.lit("."), two(6, 99)),
           of(7, 10**9, 9 * 10**9), of(8, 10**11, 9 * 10**11)]
    if card:
        d = _digits(m)
        wrong = F.concat(F.substring(d, F.lit(1), F.length(d) - 1), ((F.substring(d, -1, 1).cast("int") + 1) % 10).cast("string"))
        out += [wrong, *(F.regexp_replace(wrong, "([0-9]{4})(?=[0-9])", f"$1{sep}") for sep in ("/", ".", "-"))]
    return out


def examples(chosen: DataFrame) -> DataFrame:
    """Features, kind, label and number n of the candidates to learn from, of documents with ``_text`` and base spans."""
    shown = []
    for kind in KINDS:
        each = chosen.select("_text", F.explode(f"_{kind}").alias("s"))
        near = F.substring(F.col("_text"), F.greatest(F.col("s.a") - _NEAR + 1, F.lit(1)), F.least(F.col("s.a"), F.lit(_NEAR)))
        # words of the same text from anywhere
        far = F.substring(F.col("_text"), F.pmod(F.xxhash64("s.m"), F.greatest(F.length("_text"), F.lit(1))).cast("int") + 1, F.lit(_NEAR))
        far = F.concat(F.regexp_replace(far, r"[0-9+@().\x20/-]+", " "), F.lit(" "))
        after = F.regexp_extract(F.substring(F.col("_text"), F.col("s.b") + 1, F.lit(8)), "^[^0-9]*", 0)
        m = F.col("s.m")
        made = [F.struct(near.alias("before"), v.alias("v"), F.lit(1.0).alias("label")) for v in _forms(kind, m)]
        made += [F.struct(before.alias("before"), v.alias("v"), F.lit(0.0).alias("label"))
                 for v in _numbers(m, kind == "card") for before in (near, far)]
        shown.append(each.select(F.explode(F.array(*made)).alias("e"), after.alias("after")).where("e.v IS NOT NULL"))
    both = shown[0]
    for more in shown[1:]:
        both = both.unionByName(more)
    both = both.select(F.concat("e.before", "e.v", "after").alias("_text"), F.length("e.before").alias("va"),
                       (F.length("e.before") + F.length("e.v")).alias("vb"), "e.label")
    # equal forms are looked at once, in a fixed number of tasks: they are few bytes and much work
    parts = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(parts, "_text").groupBy("_text", "va", "vb", "label").agg(F.count("*").cast("double").alias("n"))
    both = _candidates(base_spans(materialise(both, "pii-forms"), "_text"), "_text")
    # explode would have the planner test the array's size first, on copies of all that it is made of; the null rows go below
    both = both.select(F.explode_outer("_more").alias("c"), "va", "vb", "label", "n").where("NOT c.known AND c.a < vb AND va < c.b")
    real = _candidates(chosen, "_text").select(F.explode_outer("_more").alias("c"))
    real = real.where("NOT c.known AND (c.date > 0 OR c.digits >= 13 AND c.luhn = 0)").select("c", F.lit(0.0).alias("label"), F.lit(1.0).alias("n"))
    seen = both.select("c", "label", "n").unionByName(real).withColumn("kind", _kind(F.col("c"))).where("kind IS NOT NULL")
    return seen.select(*(F.col(f"c.{f}").alias(f) for f in FEATURES), "kind", "label", "n")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text"):
    """(trees, weights, thresholds by kind) or None: a model of the candidates of all documents."""
    rows = base_spans(docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text")), "_text")
    seen = examples(materialise(rows, "pii-spans")).groupBy(*FEATURES, "kind", "label").agg(F.sum("n").alias("n"))
    seen = materialise(seen, "pii-candidates")
    if seen.select("label").distinct().count() < 2:
        return None
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(seen)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=16, weightCol="n").fit(ready)
    trees = [t._call_java("rootNode") for t in model.trees]
    weights = list(model.treeWeights)
    scored = seen.select("kind", "label", "n", _score(F.struct(*FEATURES), (trees, weights)).alias("score"))
    by = scored.groupBy("kind", "score").agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("all")).orderBy(F.desc("score")).collect()
    # no score is good enough until one is found
    right, total, threshold = dict.fromkeys(KINDS, 0.0), dict.fromkeys(KINDS, 0.0), dict.fromkeys(KINDS, float("inf"))
    for row in by:
        kind = row["kind"]
        right[kind], total[kind] = right[kind] + row["right"], total[kind] + row["all"]
        if right[kind] / total[kind] >= PRECISION:
            threshold[kind] = row["score"]
    return trees, weights, threshold


def _score(value: Column, model) -> Column:
    out = F.lit(0.0)
    for tree, weight in zip(model[0], model[1]):
        out = out + _tree(tree, value) * float(weight)
    return out


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", model=None) -> DataFrame:
    """``docs`` with ``_text`` (nulls as empty) and for each kind ``_<kind>`` (base) and ``_all_<kind>`` (all spans)."""
    rows = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    rows = base_spans(rows, "_text")
    if model is None:
        return rows.withColumns({f"_all_{k}": F.col(f"_{k}") for k in KINDS})
    rows = _candidates(rows, "_text")
    least = lambda c: F.coalesce(*(F.when(_kind(c) == k, F.lit(model[2][k])) for k in KINDS))
    rows = rows.withColumn("_more", F.filter("_more", lambda c: ~c["known"] & (_score(c, model) >= least(c))))
    of = lambda k: lambda c: _kind(c) == k
    bare = lambda c: F.struct(c["a"].alias("a"), c["b"].alias("b"), c["m"].alias("m"))
    return rows.withColumns({f"_all_{k}": F.array_sort(F.concat(
        f"_{k}", F.transform(F.filter("_more", of(k)), bare))) for k in KINDS})


def _joined(prefix: str) -> Column:
    def spelled(k):
        return lambda s: F.concat_ws(":", F.lit(k), s["a"].cast("string"), s["b"].cast("string"))

    return F.array_join(F.concat(*(F.transform(f"{prefix}{k}", spelled(k)) for k in KINDS)), ",")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row of ``docs``."""
    rows = find(docs.select(key, text), key, text, fit(docs, key, text))
    return rows.select(F.col(key).alias("doc_id"), *(F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS),
                       F.sha2(_joined("_"), 256).alias("base_sha256"), _joined("_all_").alias("spans"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by its kind in angle brackets; other columns stay.

    Spans that overlap are replaced together by the kind that begins first. A text without spans is unchanged.
    """
    columns = docs.columns
    rows = find(docs, key, text, fit(docs, key, text))
    def marked(k):
        return lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"), F.lit(k).alias("k"))

    rows = rows.withColumn("_spans", F.array_sort(F.concat(*(F.transform(f"_all_{k}", marked(k)) for k in KINDS))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, s):
        inside = s["a"] < state["at"]
        piece = F.concat(state["out"], F.substring(F.col("_text"), state["at"] + 1, s["a"] - state["at"]), F.lit("<"), s["k"], F.lit(">"))
        return F.struct(F.greatest(state["at"], s["b"]).alias("at"), F.when(inside, state["out"]).otherwise(piece).alias("out"))

    rows = rows.withColumn("_cut", F.when(F.size("_spans") > 0, F.aggregate("_spans", start, step)))
    cut = F.concat(F.col("_cut.out"), F.substring(F.col("_text"), F.col("_cut.at") + 1, F.length("_text")))
    return rows.withColumn(text, F.when(F.col("_cut").isNotNull(), cut).otherwise(F.col(text))).select(*(f"`{c}`" for c in columns))
