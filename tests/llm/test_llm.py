"""The text operators against plain versions, on odd rows: nulls, empty and long texts, repeated rows, clashing names."""

import hashlib
import re
import sys
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from kerbwatch.llm import chat, decontam, langid, longdup, pieces, pii, prints, queries, simhash, toxicity, urls
from kerbwatch.session import materialise
from tests.conftest import SMALL

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
LONG = " ".join(WORDS[(i * i) % 20] + str(i % 7) for i in range(4000))
ODD = [(1, None), (2, ""), (3, "  \n"), (4, " ".join(WORDS)), (4, " ".join(WORDS)), (5, " ".join(WORDS[:9]) + " x"), (6, LONG), (7, LONG + " tail"),
       (8, "And " * 300), (9, "écoute Ünïcode 😀 ▁mark a@b.co +1 (555) 010-9999"), (10, "x"), (11, "1.2.3.4 4111 1111 1111 1111")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "src", 0, "clash", "clash") for i, t in ODD]
    return materialise(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, raw string"), "odd")


@pytest.fixture(scope="module")
def none(odd):
    return materialise(odd.where("doc_id < 0"), "none")


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(4, 0), (5, 1), (9, 1), (6, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(odd, labels)
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0
    rng = np.random.default_rng(3)
    rows = [(np.unique(np.r_[rng.integers(2, 50, 8), [1] if y else []]).astype(int), y) for y in rng.integers(0, 2, 400)]
    w, b = toxicity.ftrl(rows, 6)
    assert np.mean([(w[f].sum() + b > 0) == y for f, y in rows]) > 0.95


def test_features_across_blocks(monkeypatch):
    text = b"one two three four five six seven eight"
    whole = {f for _, fs in [(0, np.concatenate([f for _, f in toxicity.Features().pieces([text])]))] for f in fs.tolist()}
    monkeypatch.setattr(toxicity, "BLOCK", 24)
    cut = {f for _, part in toxicity.Features().pieces([text]) for f in part.tolist()}
    assert whole == cut


def test_language(spark, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.fit(docs.where("doc_id % 2 = 0"))
    got = langid.predict(docs.where("doc_id % 2 = 1"), model).join(docs, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    odd = spark.createDataFrame([(1, None), (2, "123 !"), (3, "qxzj wvkq zzxq jqvw" * 30)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert got[1].lang_pred == got[2].lang_pred == "und" and got[1].score == 0 and got[1].rejected and got[3].rejected
    empty = langid.fit(none)
    assert [r.lang_pred for r in langid.predict(odd, empty).collect()] == ["und"] * 3


@pytest.mark.parametrize("entries", [1 << 21, 4000, 400])
def test_language_with_a_small_model(spark, entries):
    """However few grams are kept, clean texts are not rejected, and small languages neither vanish nor take over."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang IS NOT NULL")
    rare = spark.createDataFrame([(900_000 + i, f"ωκ λψ{chr(0x3b1 + i % 20)} φξ ζη θπ{chr(0x3b1 + i % 7)}", "rare") for i in range(3)], "doc_id bigint, text string, lang string")
    train = docs.where("doc_id % 2 = 0").select("doc_id", "text", "lang").unionByName(rare)
    model = langid.fit(train, entries=entries * 5, per_language=entries)
    test = docs.where("doc_id % 2 = 1 AND length(text) > 200")
    got = langid.predict(test, model).join(test.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > (0.97 if entries > 400 else 0.9) and not any(r.lang_pred == "rare" for r in got)
    assert np.mean([r.rejected for r in got]) < 0.02
    assert [r.lang_pred for r in langid.predict(rare, model).collect()] == ["rare"] * 3


def test_levels_in_spark_are_those_of_one_language(spark):
    code, n = np.unique(langid.grams(langid.symbols(LONG.encode(), langid.alphabet())), return_counts=True)
    found = spark.createDataFrame([("x", int(c.view(np.int64)), int(k)) for c, k in zip(code, n)], "lang string, gram bigint, n bigint")
    whole = langid.kneser_ney(code, n)
    rows = langid.levels(found).collect()
    c = {(r.order, r.gram & ((1 << 64) - 1)): (r.c, r.total, r.kinds) for r in rows}
    assert len(c) == sum(len(whole[f"gram{k}"]) for k in (1, 2, 3, 4))
    model = langid.fit(spark.createDataFrame([(1, LONG, "x")], "doc_id bigint, text string, lang string"))
    for k in (1, 2, 3, 4):
        assert (model[f"gram{k}"] == whole[f"gram{k}"]).all() and np.allclose(model[f"logp{k}"][:, 0], whole[f"logp{k}"], rtol=1e-5)
        assert np.allclose(model[f"back{k}"][:, 0], whole[f"back{k}"], rtol=1e-5)


def test_kneser_ney_sums_to_one():
    c = langid.symbols("the cat sat on the mat, the rat ate that hat".encode(), langid.alphabet())
    code, n = np.unique(langid.grams(c), return_counts=True)
    m = langid.union([langid.kneser_ney(code, n)])
    seen = np.unique(code & np.uint64(0xFFFF))
    for context in (code[0] >> np.uint64(16), code[9] >> np.uint64(16)):
        p = np.exp(langid.log_probability(m, (context << np.uint64(16)) | seen)[:, 0])
        assert 0.8 < p.sum() <= 1.0001


def plain_fingerprint(text, width):
    import xxhash
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash(spark, odd, none):
    docs = odd.select("doc_id", "text").union(spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("doc_id + 100", "text"))
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    fp = [plain_fingerprint(t, 4) for _, t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if bin(fp[i] ^ fp[j]).count("1") <= 4:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {r: min(texts[i][0] for i in range(len(texts)) if root[i] == r) for r in set(root)}
    want = sorted((texts[i][0], f"{fp[i]:016x}", least[root[i]]) for i in range(len(texts)))
    got = simhash.near_groups(docs)
    assert sorted(map(tuple, got.select("doc_id", simhash.hexed("fp"), "component_id").collect())) == want
    assert simhash.near_groups(none).count() == 0


def test_simhash_hot_groups(spark, monkeypatch):
    rng = np.random.default_rng(5)
    values = sorted({int(np.int64(7 << 40) ^ sum(1 << int(b) for b in rng.integers(0, 30, rng.integers(0, 5)))) for _ in range(600)})
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")

    def classes(df):
        label = np.arange(len(values))
        pairs = [(values.index(r.a), values.index(r.b)) for r in df.collect()]
        simhash.merge(label, np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
        return label.tolist()

    whole = classes(simhash.links(fps))
    monkeypatch.setattr(simhash, "HOT", 100)
    assert classes(simhash.links(fps)) == whole


def plain_spans(text):
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
             ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
    out = []
    for kind, pattern in kinds:
        for m in re.finditer(pattern, text or ""):
            d = [int(c) for c in m.group() if c.isdigit()]
            luhn = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
            good = {"email": True, "ip": kind != "ip" or max(map(int, m.group().split("."))) <= 255,
                    "card": 13 <= len(d) <= 19 and luhn % 10 == 0, "phone": 9 <= len(d) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_personal_data(spark, odd, none):
    more = [(20, "a@b.c%d@e.f g@h a..b@c-d.e."), (21, "1.2.3.4.5.6.7.8 256.1.1.1 00255.1.1.1"), (22, "4111 1111-1111 1111 41111111111111115 4111--1111"),
            (23, "+12 +1 2 3 4 5 6 7 8 9 0 1"), (24, "9" * 3000), (25, "+" + "(" * 3000)]
    docs = materialise(odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string")), "odd")
    texts = dict(ODD + more)
    rows = pii.find(docs).select("doc_id", pii._joined("_").alias("s")).collect()
    assert all(r.s.split(",") == (plain_spans(texts[r.doc_id]) or [""]) for r in rows) and len(rows) == docs.count()
    got = {r.doc_id: r.text for r in pii.redact(odd).collect()}
    assert got[9].endswith("▁mark <email> <phone>") and got[11] == "<ip> 4111 1111 1111 1111" and got[6] == LONG and got[1] is None
    assert pii.report(none).count() == 0


def test_personal_data_in_other_forms(spark):
    rng = np.random.default_rng(2)
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    rows = [(i, f"plain words here, mail me at user{i}@host{i}.com or call +1 {rng.integers(200, 999)} {digits(3)} {digits(4)} or pay by card "
                f"4111 1111 1111 1111 on 20{i % 90 + 10}-03-0{i % 9 + 1} for 12{digits(6)}.50 under number {digits(12)} as said") for i in range(200)]
    rows += [(900, "please mail me at jane.roe at example dot org today"), (901, "or call 1 555 010 9999 today"), (902, "pay by card 4111/1111/1111/1111 now"),
             (910, "it was on 2021-03-04 12 in all"), (911, "under number 4111/1111/1111/1112 as said"), (912, "the sum is 123456789.50 in all")]
    docs = materialise(spark.createDataFrame(rows, "doc_id bigint, text string"), "other-forms")
    got = {r.doc_id: r.spans for r in pii.report(docs).where("doc_id >= 900").collect()}
    assert [got[k].split(":")[0] for k in (900, 901, 902)] == ["email", "phone", "card"]
    assert got[910] == got[911] == got[912] == ""


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://WWW.Example.com/en/1"), (4, "https://a.example.com/en/2?q=1"), (5, "http://x.net/es/1"),
            (6, "http://x.net"), (7, "http://x.net/es/1"), (8, "ftp://x.org/fr/#a")] + [(10 + i, f"http://bad{i}.spam.net/fr/{i}") for i in range(20)]
    rows += [(40, "http://q.spam.org/fr/1")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("", "", None, "allow") and got[2].host == ""
    assert (got[3].rule, got[3].verdict, got[3].host) == ("www.example.com/en/", "allow", "www.example.com")
    assert got[4].rule == "example.com/en/" and got[5].rule == "net/es/" and got[6].path == "" and len(got) == len(rows)
    assert (got[40].rule, got[40].verdict, got[40].by) == (None, "block", "mined")


def test_decontamination(spark, odd, none):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.sql(queries.SQL["op6_decontamination"])
    got = queries.QUERIES["op6_decontamination"](spark, SMALL)
    assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(want.fetchall())
    items = spark.createDataFrame([(1, " ".join(WORDS[2:14])), (2, "pi rho"), (3, None), (4, ""), (2, "pi rho"), (5, LONG)], "item_id bigint, text string")
    one = decontam.report(odd, items).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, decontam.report(odd, items, shard_words=15).collect()))
    assert [(r.n_words, r.n_hit, r.n_items) for r in one if r.doc_id == 4] == [(20, 14, 2)] * 2
    kept = decontam.decontaminate(odd, items.where("item_id < 3"), max_coverage=0.8)
    assert {r.doc_id: r.text for r in kept.collect()}[4] == "alpha beta  omicron  sigma tau upsilon" and kept.columns == odd.columns
    assert not any(r.contaminated for r in decontam.report(odd, items.where("item_id = 0")).collect())
    assert decontam.report(none, items).count() == 0


def test_decontaminate_in_shards(spark, odd):
    w = [f"v{i}" for i in range(60)]
    items = [" ".join(w[:12]), " ".join(w[12:24]), " ".join(w[20:32]), " ".join(w[40:52])]
    items = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    rows = [(30, w[:10] + ["x"] * 5 + w[40:50]),  # two fifths each of two items
            (31, ["x"] * 30 + w[12:32] + ["y"] * 30),  # items that overlap
            (32, ["x"] * 30 + w[:6] + w[40:52] + w[6:12] + ["y"] * 30),  # an earlier item arises when a later one is cut
            (33, ["x"] * 30)]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(k, " ".join(t)) for k, t in rows], "doc_id bigint, text string"))
    docs = materialise(docs, "sharded")
    one, cut = ({(r.doc_id, r.text) for r in decontam.decontaminate(docs, items, shard_words=n).collect()} for n in (1000, 15))
    assert one == cut and {k: t.split() for k, t in cut if k >= 30} == {k: ["x"] * 30 + ["y"] * 30 * (k < 33) for k in (31, 32, 33)}


def test_long_repeats(spark, odd, none):
    rows = [(i, (t or "").encode()) for i, t in ODD]
    count = Counter(b[s:s + 400] for _, b in rows for s in range(len(b) - 399))
    want = []
    for i, b in rows:
        gone = [False] * len(b)
        for s in range(len(b) - 399):
            if count[b[s:s + 400]] > 1:
                gone[s:s + 400] = [True] * 400
        kept = bytes(c for c, g in zip(b, gone) if not g)
        want.append((i, len(b), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    assert sorted(map(tuple, longdup.report(odd).collect())) == sorted(want)
    assert longdup.report(none).count() == 0


def test_long_repeats_hot_files(spark, odd, monkeypatch):
    whole = sorted(map(tuple, longdup.report(odd).collect()))
    monkeypatch.setattr(longdup, "HOT", 0)
    assert sorted(map(tuple, longdup.report(odd).collect())) == whole


def test_pieces(spark, odd, none):
    out = materialise(pieces.encode(odd), "pieces")
    assert all(r.lossless for r in out.collect()) and out.count() == len(ODD)
    back = pieces.decode(out)
    assert sorted(map(str, ((r.doc_id, r.text) for r in back.collect()))) == sorted(map(str, ODD))
    assert [tuple(r.ids or ()) for r in out.orderBy("doc_id").collect()] == [tuple(r.ids or ()) for r in pieces.encode(odd).orderBy("doc_id").collect()]
    with open(pieces.MODEL, "rb") as f:
        v = pieces.Vocabulary(f.read())
    drawn = Counter(tuple(v.encode(b" other", s)) for s in range(3000))
    likely = {ids: np.prod([v.weight[v.text[i]][1] for i in ids]) for ids in drawn}
    total = sum(likely.values())
    assert all(abs(n / 3000 - likely[ids] / total) < 0.05 for ids, n in drawn.items())
    assert pieces.encode(none).count() == 0


def test_pieces_of_chunks_one_by_one_and_together(monkeypatch):
    with open(pieces.MODEL, "rb") as f:
        v = pieces.Vocabulary(f.read())
    texts = [(t or "").encode() for _, t in ODD] + [b"x" * 63 + b" " + b"y" * 65, b"\xff\x00 abc" * 9, "日本語の長い文".encode() * 40]
    together = v.encode_all(texts, list(range(len(texts))))
    monkeypatch.setattr(pieces, "LONG", 0)
    one_by_one = v.encode_all(texts, list(range(len(texts))))
    assert together[0].tolist() == one_by_one[0].tolist() and together[1].tolist() == one_by_one[1].tolist()
    assert v.decode(together[0].tolist()) == b"".join(texts)
    assert one_by_one[0].tolist() == [i for n, t in enumerate(texts) for i in v.encode(t, n)]


def test_chat(spark):
    call = '{"tool_calls": [{"id": "%s", "name": "ask", "arguments": %s}]}'
    rows = [(1, 0, "user", "hello"), (1, 1, "assistant", call % ("a", '{"query": "q", "size": 1}')), (1, 2, "tool", '{"tool_call_id": "a", "content": {"b": 1, "a": 2}}'),
            (1, 3, "assistant", call % ("b", '{"query": "q", "size": "x", "after": {"$ref": "a"}}')), (1, 4, "tool", '{"tool_call_id": "zz", "content": 1}'),
            (1, 5, "assistant", call % ("c", '{"query": "q", "size": 1, "after": {"$ref": "c"}}')), (1, 6, "assistant", call % ("a", '{"query": "again", "size": 1}')),
            (2, 0, "user", None), (2, 1, "user", "{broken")]
    got = {(r.conv_id, r.turn): r for r in chat.format_chat(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), chat.ASK).collect()}
    assert len(got) == len(rows)
    assert [got[1, t].status for t in range(7)] == ["prose", "linked", "linked", "no result", "no call", "unordered", "duplicate"]
    assert got[1, 3].level == 1 and got[1, 3].error == "size is no integer" and got[1, 1].error is None
    assert got[1, 2].json == '{"content":{"a":2,"b":1},"id":"a","role":"tool","type":"result"}' and got[2, 0].json == '{"content":"","role":"user","type":"prose"}'


def test_chat_against_brute_force(spark):
    """The registered query's rows: links, levels, errors and statuses of every part, worked out one by one."""
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    columns = ["conv_id", "turn", "role", "text"]
    call = """concat('{"tool_calls": [{"id": "', id, '", "name": "ask", "arguments": {"query": "q", "size": 1', {}, '}}]}')"""
    refs = ["CASE WHEN id = 0 THEN '' ELSE concat(', \"after\": {\"$ref\": \"', id - 1, '\"}') END",  # one long chain
            "CASE WHEN id < 2 THEN '' ELSE concat(', \"after\": [{\"$ref\": \"', id - 1, '\"}, {\"$ref\": \"', id - 2, '\"}]') END",
            "concat(', \"after\": {\"$ref\": \"', 1 - id, '\"}')"]  # two that wait for each other
    kind = turns.schema["turn"].dataType.simpleString()
    long = [spark.range(0, n).selectExpr(f"{999_990 + k}L AS conv_id", f"cast(id AS {kind}) AS turn", "'assistant' AS role", call.replace(", {}, ", f", {r}, ") + " AS text") for k, (n, r) in enumerate(zip((600, 6, 2), refs))]
    messages = chat.as_tool_chat(turns.select(columns).unionByName(turns.where("conv_id % 5 = 0").select(columns)))
    messages = materialise(messages.unionByName(long[0]).unionByName(long[1]).unionByName(long[2]), "tool-chat")
    rows = [(r.conv_id, r.turn, r.role, i, *p) for r in messages.collect() for i, p in enumerate(chat.parts_of(r.text))]
    first = {}
    for c, t, role, i, kind, ident, name, body, refs in rows:
        if kind != "prose":
            first[c, kind, ident] = min(first.get((c, kind, ident), (t, body, i, role, refs)), (t, body, i, role, refs))
    level = {}
    sys.setrecursionlimit(10_000)

    def find(c, ident, path):
        if (c, ident) not in level:
            call = first.get((c, "call", ident))
            if call is None or ident in path:
                return None
            below = [find(c, r, path | {ident}) for r in call[4]]
            level[c, ident] = None if None in below else 1 + max(below, default=-1)
        return level[c, ident]

    want, taken = Counter(), set()
    for c, t, role, i, kind, ident, name, body, refs in rows:
        deep = find(c, ident, frozenset()) if kind != "prose" else None
        if kind == "prose":
            status = "prose"
        elif first[c, kind, ident][:3] != (t, body, i) or (c, kind, ident) in taken:
            status = "duplicate"
        elif kind == "result" and (c, "call", ident) not in first:
            status = "no call"
        elif kind == "call" and deep is None:
            status = "unordered"
        elif kind == "call" and (c, "result", ident) not in first:
            status = "no result"
        else:
            status = "linked"
        taken.add((c, kind, ident))
        want[c, t, i, kind, ident, deep or 0, status, chat.check(body, chat.ASK.get(name)) if kind == "call" else None] += 1
    got = chat.format_chat(messages, chat.ASK).collect()
    assert Counter((r.conv_id, r.turn, r.part, r.kind, r.id, r.level, r.status, r.error) for r in got) == want
    assert {"linked", "duplicate", "unordered", "no result"} <= {k[6] for k in want} and max(k[5] for k in want) == 599
    assert {"unknown tool", "missing query", "missing size"} & {k[7] for k in want}
    assert chat.format_chat(messages.where("false"), chat.ASK).count() == 0


def test_fingerprints(spark, odd, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()))
    got = {r.doc_id: r for r in prints.report(docs).collect()}

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    off = []
    for (i, a), (_, b) in zip(rows, rows[1:] + rows[:1]):
        half = len(a) // 2
        e = a[:len(a) - half] + b[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(a), hashlib.sha256(e.encode()).hexdigest())
        x, y = shingles(a), shingles(e)
        off.append(got[i].near_edited - len(x & y) / len(x | y))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.06
    same = prints.report(odd).collect()
    assert len(same) == len(ODD) and len({r.fingerprint for r in same if r.doc_id in (1, 2, 3)}) == 1
    assert prints.report(none).count() == 0


def test_one_of_each_near_group_against_brute_force(spark, odd, none):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(25):
        base = [f"w{x}" for x in rng.integers(0, 4000, 150)]
        for k in (0, 0, 1, 1, 30):
            copy = list(base)
            for at in rng.integers(0, 150, k):
                copy[at] = f"new{rng.integers(0, 4000)}"
            rows.append((len(rows) + 1, " ".join(copy)))
    rows += [(None, rows[0][1]), (None, "alone and without an id at all"), (1, "another text under an id that is taken"), (None, None), (900, ""), rows[4], rows[4]]
    docs = spark.createDataFrame([(*r, 1, "a", "b") for r in rows], "doc_id bigint, text string, fp int, th string, root string").repartition(4)
    docs = materialise(docs, "near-copies")
    fps = [plain_fingerprint(t, 4) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                label = [label[j] if x == label[i] else x for x in label]
    least = {x: min((k is None, k or 0) for (k, _), y in zip(rows, label) if x == y) for x in label}
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    name = {(k, t or ""): x for (k, t), x in zip(rows, label)}
    kept = [(name[r.doc_id, r.text or ""], (r.doc_id is None, r.doc_id or 0)) for r in got.collect()]
    assert sorted(kept) == sorted(least.items()) and 30 < len(kept) < len(rows) - 30
    assert sorted(map(str, corpus_pipeline.one_of_each_group(spark, docs, SMALL).collect())) == sorted(map(str, got.collect()))
    assert simhash.one_of_each(none).count() == 0 and simhash.one_of_each(odd).columns == odd.columns


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, SMALL), name)
        assert docs.columns == names and 0.5 * before.count() < docs.count() <= before.count(), name
    last = corpus_pipeline.as_pieces(spark, docs, SMALL)
    assert last.count() == docs.count() and last.where("NOT lossless").count() == 0
    left = decontam.report(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    assert left.where("contaminated").count() == 0


def test_language_limits_come_from_all_training_texts(spark, monkeypatch):
    texts = ["the cat sat on the mat and the dog lay by the door " * (1 + i % 3) + "abcdefghij"[i % 10] * 3 for i in range(3000)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    model = langid.fit(docs)
    ce, n = langid._cross_entropies([t.encode() for t in texts], model, langid.alphabet())
    mean = np.average(ce[:, 0], weights=n)
    assert np.isclose(model["mean"][0], mean) and np.isclose(model["deviation"][0], np.sqrt(np.mean(n * (ce[:, 0] - mean) ** 2)))


def test_personal_data_is_learned_from_all_documents(spark, monkeypatch):
    many = spark.range(40_000).selectExpr("id AS doc_id", "if(id % 100 = 0, concat('write to a', id, '@x.org'), 'nothing') AS text")
    made = {}
    monkeypatch.setattr(pii, "materialise", lambda df, label, write=pii.materialise: made.setdefault(label, write(df, label)))
    assert pii.fit(many)[2]["email"] < float("inf")
    assert made["pii-candidates"].where("kind = 'email' AND label = 1").agg({"n": "sum"}).first()[0] == 3 * 400


def test_language_model_is_whole_however_few_grams_tasks_hold(spark):
    """Grams that tasks do not hold are looked up in the whole model: scores do not depend on the bounds."""
    words = "the cat sat on a mat and its dog lay by that door".split(), "le chat est sur un lit et son chien dort par terre".split()
    texts = [(i % 7, " ".join(words[i % 2][(i * j + j * j // 3) % 11] + chr(97 + (i + j) % 26) for j in range(40)), ("en", "fr")[i % 2]) for i in range(60)]
    texts += [(None, None, "en"), (3, "", "fr"), (3, "12 + 3", None), (3, "12 + 3", None), (61, "Ωμέγα zzxq", None), (62, "the 𐐷 cat", "en")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    whole = langid.fit(docs)
    want = sorted(map(repr, ((r.doc_id, r.lang_pred, round(r.score, 3), r.cross_entropy and round(r.cross_entropy, 3), r.rejected) for r in langid.predict(docs, whole).collect())))
    kept = sorted(map(repr, langid.keep(docs, whole).collect()))
    for most in (1, 60):
        model = langid.fit(docs, entries=2 * most, per_language=most)
        assert np.allclose(model["mean"], whole["mean"], rtol=1e-5) and np.allclose(model["deviation"], whole["deviation"], rtol=1e-4)
        got = langid.predict(docs, model).collect()
        assert sorted(map(repr, ((r.doc_id, r.lang_pred, round(r.score, 3), r.cross_entropy and round(r.cross_entropy, 3), r.rejected) for r in got))) == want
        assert sorted(map(repr, langid.keep(docs, model).collect())) == kept
        assert len(model["gram4"]) <= most and "gram4" in model["open"] and not whole.get("open")


def test_personal_data_looks_at_each_candidate_once(spark):
    """No filter below an explode has copies of the expressions that find the candidates."""
    docs = spark.createDataFrame([("write to a@x.org or call +1 (555) 123-4567, on 2024-01-02",), ("",)], "_text string")
    seen = pii.examples(pii.base_spans(docs, "_text").localCheckpoint())
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.split("\n") if line.lstrip(" :+-").startswith("Filter")]
    assert conditions and not any("transform(" in line for line in conditions)
    assert {(r.kind, r.label) for r in seen.collect()} >= {("email", 1.0), ("phone", 1.0), ("phone", 0.0)}
