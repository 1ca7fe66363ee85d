"""Each operator against a brute-force version on small, hostile tables: null and
empty texts, very long ones, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, decontaminate, jaccard, langid, lattice, phrases, pieces, setparts, tokencount, topk, toxicity, urls

DOCS = "doc_id long, text string, _spans string, h string, n string, word string, count string, component string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x", "x") for i, t in rows], DOCS)


def prose(r, n, vocabulary=400):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(5)
    rows = [(i, prose(r, r.randrange(1, 260))) for i in range(60)]
    passage = prose(r, 70)
    line = prose(r, 30)
    for i in range(60, 130):  # one passage and one line in many documents
        own = prose(r, 90).split()
        own[40:40] = passage.split() if i % 2 else line.split()
        rows.append((i, " ".join(own)))
    base = prose(r, 150).split()
    for i in range(130, 190):  # near copies, in steps that chain
        near = list(base)
        for _ in range(i % 17):
            near[r.randrange(len(near))] = f"x{r.randrange(99)}"
        rows.append((i, " ".join(near)))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "ONE"), (205, "one two  three"), (206, "la " * 400), (207, "la " * 300), (208, prose(r, 9_000)), (209, "ü" * 3_000)]
    rows += [(210, rows[3][1]), (210, rows[3][1]), (None, rows[3][1]), (None, None), (211, "a b c d\x1ce\u2003f")]
    rows.append((212, rows[-7][1] + " tail"))
    r.shuffle(rows)
    return rows


def test_substring_dedup(spark, corpus):
    first = {}
    for i, t in corpus:
        w = WORD.findall(t or "")
        for p in range(len(w) - 49):
            if i is not None:
                k = tuple(w[p : p + 50])
                first[k] = min(i, first.get(k, i))
    want = []
    for i, t in corpus:
        w = WORD.findall(t or "")
        gone = {q for p in range(len(w) - 49) if i is not None and first[tuple(w[p : p + 50])] < i for q in range(p, p + 50)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    for many in (200, 3):  # 3: most anchors are frequent and their passages split
        got = [tuple(x) for x in phrases.digests(documents(spark, corpus), many=many).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)
    rows = phrases.without_repeats(documents(spark, corpus))
    assert rows.columns == documents(spark, []).columns and rows.count() == len(corpus)


@pytest.mark.parametrize(("k", "similar"), [(4, (85, 100)), (5, (80, 100)), (2, (60, 100))])
def test_jaccard_join(spark, corpus, k, similar, monkeypatch):
    monkeypatch.setattr(jaccard, "ALL_PAIRS", 4)
    monkeypatch.setattr(jaccard, "COMMON_IN", 20)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def shingles(t):
        w = WORD.findall((t or "").translate(lower))
        return {tuple(w[p : p + k]) for p in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    sets = [(i, shingles(t)) for i, t in corpus]
    comp = {i: i for i, _ in sets if i is not None}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and similar[1] * len(x & y) >= similar[0] * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                comp[hi] = lo
    by_set = {frozenset(x): find(i) for i, x in sets if i is not None and x}
    want = [(i, len(x), find(i) if i is not None else by_set.get(frozenset(x))) for i, x in sets]
    got = [tuple(x) for x in jaccard.linked(documents(spark, corpus), k, similar).collect()]
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_signatures_miss_no_pair():
    r = random.Random(1)
    import numpy as np

    for num, den in ((85, 100), (80, 100), (60, 100)):
        classes = setparts.Classes(num, den)
        for _ in range(400):
            n = r.choice((3, 6, 8, 12, 20, 50, 200))
            a = np.unique(np.array([r.getrandbits(64) for _ in range(n)], dtype=np.uint64))
            drop = r.randrange(0, max(1, n // 4) + 1)
            b = np.unique(np.concatenate([a[drop:], np.array([r.getrandbits(64) for _ in range(r.randrange(0, max(1, n // 6) + 1))], dtype=np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if den * shared < num * (len(a) + len(b) - shared) or np.array_equal(a, b):
                continue
            common = np.sort(a[: n // 2])
            x, y = ({(k != 0, int(s)) for k, v in setparts.signatures(z, classes, common) for s in v} for z in (a, b))
            assert x & y


def test_token_counts_and_lattice(spark, corpus):
    model = pieces.load()
    rows = [*corpus, (300, "日本語 naïve café 🙂 \u0001 don't"), (301, "x" * 90 + " " + "the" * 40)]
    spelt = {w: pieces.viterbi(w, model) for _, t in rows for w in WORD.findall(t or "")}
    want = sorted(((i is None, i or 0), len(w := WORD.findall(t or "")), sum(len(spelt[x]) for x in w)) for i, t in rows)
    docs = documents(spark, rows)
    assert sorted(((r[0] is None, r[0] or 0), r[1], r[2]) for r in tokencount.token_counts(docs).collect()) == want
    trie = tokencount.Trie(model)
    for w in spelt:
        assert trie.tokens(w) == len(spelt[w])
    for frequent in (200_000, 5):
        got = lattice.digests(docs, frequent=frequent).collect()
        assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_words, r.n_pieces) for r in got) == want
        assert all(r.n_exact == r.n_words for r in got)
    table, _ = lattice.encode(docs)
    assert {r.word: list(r.ids) for r in table.collect()} == spelt


def test_every_text_has_its_ids_and_is_decoded(spark):
    """Frequent and other words in any order, with long, odd and repeated rows."""
    model = pieces.load()
    rows = [(1, "the cat\tthe  zyxq the"), (1, "zyxq the \U0001f642 caf\xe9 zyxq"), (None, "qqq"), (2, None), (3, " \n"), (4, "the " * 3000 + "w" * 300 + " the"), (4, "the cat\tthe  zyxq the")]
    rows.append((5, " ".join(f"x{i % 97}y{i}" if i % 3 else "the" for i in range(2000))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = []
    for i, t in rows:
        words = (t or "").encode().split()
        ids = [x for w in words for x in pieces.viterbi(w.decode(), model)]
        want.append((i or 0, len(words), len(ids), len(words), hashlib.sha256(b" ".join(words)).hexdigest(), ids))
    for frequent in (200_000, 2):
        got = lattice.digests(docs, frequent=frequent).collect()
        assert sorted((r.doc_id or 0, r.n_words, r.n_pieces, r.n_exact, r.decoded_sha256, list(r.ids)) for r in got) == sorted(want)


def test_viterbi_is_best():
    model = pieces.load()
    r = random.Random(3)

    def all_scores(text):
        if not text:
            return [(0, 0)]
        out = []
        for n in range(1, len(text) + 1):
            s = model.scores.get(text[:n])
            head = (s, 1) if s is not None else (model.fallback(text[0]) if n == 1 else None)
            if head:
                out += [(head[0] + a, head[1] + b) for a, b in all_scores(text[n:])]
        return out

    for _ in range(60):
        word = "".join(r.choice("theraniosé¿") for _ in range(r.randrange(1, 8)))
        best = max(all_scores(pieces.SPACE + word), key=lambda x: (x[0], -x[1]))
        assert len(pieces.viterbi(word, model)) == best[1]


def test_chat(spark):
    nasty = ["", None, r"\### user: </turn> ok", "a\\", "### ", " </turn>\n### assistant: x </turn>\n", "ü🙂<#:\\", "<" * 5_000]
    rows = [(c, t, r, nasty[(c + t) % len(nasty)], 1) for c in range(6) for t, r in enumerate(("system", "user", "assistant", None, "as:s#"))]
    rows += [(1, 2, "assistant", "tie b", 1), (1, 2, "assistant", "tie a", 1), (None, 0, "assistant", "no id", 1), (2, None, "user", "first", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece int")
    want = {}
    for c in {x[0] for x in rows}:
        own = sorted(((t is not None, t or 0, r or "", x or "") for k, t, r, x, _ in rows if k == c))
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        turns = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        want[c] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = {r[0]: tuple(r[1:5]) for r in chat.digests(chat.to_turns(df)).collect()}
    assert got == want
    for piece, role, text in chat.format_turns(chat.to_turns(df)).select("piece", "conv_id", "turn").limit(0).collect():
        assert chat.read_back(piece)
    assert chat.digests(chat.to_turns(df.limit(0))).count() == 0


def test_layouts(spark):
    same = [(0, "user", "hi"), (1, "assistant", "yo")]
    frames = [
        spark.createDataFrame([(1, [("user", "hi"), ("assistant", "yo")])], "conv_id long, messages array<struct<role:string,content:string>>"),
        spark.createDataFrame([(1, [("human", "hi"), ("gpt", "yo")], 5)], "conv_id long, conversations array<struct<from:string,value:string>>, extra int"),
        spark.createDataFrame([(1, "hi", "yo")], "conv_id long, prompt string, response string"),
        spark.createDataFrame([(1, "hi", None, "yo")], "conv_id long, instruction string, input string, output string"),
    ]
    for df in frames:
        assert sorted(tuple(r)[1:] for r in chat.to_turns(df).collect()) == same
    with pytest.raises(ValueError, match="no layout"):
        chat.choose(spark.createDataFrame([(1,)], "other int").schema)


def test_top_k(spark):
    r = random.Random(7)
    rows = [(i, [r.choice((-0.5, 0.0, 0.25, r.uniform(-1, 1))) for _ in range(10)]) for i in range(150)]
    rows += [(200, None), (201, [1.0, None] + [0.0] * 8), (202, [float("nan")] * 10), (203, [float("inf")] * 10), (204, [1.0, 2.0]), (205, []), (None, [0.1] * 10), (0, rows[0][1]), (7, rows[7][1]), (206, [1e18] * 10)]
    df = spark.createDataFrame([(a, b, 0) for a, b in rows], "vec_id long, embedding array<double>, rank int")
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    top = (1 << 63) - 1
    want = []
    for q in sorted({i for i, _ in whole if i % 50 == 0}):
        v = min(v for i, v in whole if i == q)
        hits = sorted((-max(-top - 1, min(top, sum(a * b for a, b in zip(v, x, strict=True)))), i) for i, x in whole if i != q and len(x) == len(v))[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(hits)]
    for groups in (1, 8):
        got = sorted(tuple(x) for x in topk.top_k(df, F.col("vec_id") % 50 == 0, groups=groups).collect())
        assert got == sorted(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_decontamination(spark):
    r = random.Random(9)
    items = [(0, prose(r, 30)), (1, prose(r, 12)), (2, "too short"), (3, None), (4, ""), (5, prose(r, 60))]
    items.append((6, items[1][1].upper()))
    docs = [(i, prose(r, 40) + " " + (items[i % 7][1] or "") + "! " + prose(r, 10)) for i in range(20)]
    docs += [(30, None), (31, ""), (32, prose(r, 5_000) + " " + items[0][1]), (33, " ".join(items[5][1].split()[:52])), (34, " ".join(items[5][1].split()[:40])), (1, docs[1][1]), (None, docs[1][1])]
    norm = lambda t: [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
    sh = lambda t: {tuple(norm(t)[p : p + 5]) for p in range(len(norm(t)) - 4)}
    want = set()
    for d, t in docs:
        for i, q in items:
            if d is not None and sh(q) and len(sh(q) & sh(t)) * 100 >= 80 * len(sh(q)):
                want.add((d, i, len(sh(q) & sh(t)), len(sh(q))))
    bench = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, h string")
    got = [tuple(x) for x in decontaminate.contained(documents(spark, docs), bench).collect()]
    assert sorted(got) == sorted(want)
    kept = decontaminate.without_items(documents(spark, docs), bench)
    assert sorted((x.doc_id is None, x.doc_id or 0) for x in kept.collect()) == sorted((d is None, d or 0) for d, _ in docs if d is None or not any(w[0] == d for w in want))
    assert decontaminate.contained(documents(spark, docs), bench.limit(0)).count() == 0


RULES = (urls.Rule("allow", "org/"), urls.Rule("block", "example.org/es/"), urls.Rule("block", "example.org/en/1"), urls.Rule("allow", "com/fr/"), urls.Rule("block", "com/de/"))


def test_urls(spark):
    r = random.Random(2)
    rows = [(i, f"http{'s' * (i % 2)}://{r.choice(('a', 'www.b', 'EXAMPLE'))}.{r.choice(('org', 'com', 'example.org', 'net'))}/{r.choice(('es', 'en', 'fr', 'de'))}/{r.randrange(300)}{r.choice(('', '?q=/x', '#top'))}") for i in range(300)]
    rows += [(400, None), (401, ""), (402, "no scheme.org/"), (403, "x://ORG/"), (404, "x://org"), (405, "x://notorg/"), (406, "x://a.org?x=/y"), (407, "x://a.com/fr"), (1, rows[1][1])]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "page_id long, url string, score string")
    got = urls.judge(df, RULES).collect()
    assert len(got) == len(rows)

    def split(u):
        if u is None or "://" not in u:
            return "", ""
        rest = u.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        return host.lower(), re.match(r"[^?#]*", rest[len(host) :])[0]

    def rule(u):
        host, path = split(u)
        fits = [x for x in RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        return max(fits, key=lambda x: len(x.rule), default=None)

    # the models, by counting
    labelled = {(u or ""): (x.verdict if (x := rule(u)) else None) for _, u in rows}
    fold = {x.u: x.f for x in spark.createDataFrame([(u,) for u in labelled], "u string").select("u", F.pmod(F.xxhash64("u"), F.lit(urls.FOLDS)).alias("f")).collect()}
    counts = {"allow": {}, "block": {}}
    for u, v in labelled.items():
        if v and fold[u]:
            t = urls.START + u + urls.END
            for i in range(1, len(t)):
                for o in range(urls.ORDER + 1):
                    if i - o >= 0:
                        d = counts[v].setdefault(t[i - o : i], {})
                        d[t[i]] = d.get(t[i], 0) + 1

    def logp(v, u):
        t, total = urls.START + u + urls.END, 0.0
        for i in range(1, len(t)):
            p = 1.0 / urls.ALPHABET
            for o in range(min(urls.ORDER, i) + 1):
                d = counts[v].get(t[i - o : i], {})
                if d:
                    p = (d.get(t[i], 0) + len(d) * p) / (sum(d.values()) + len(d))
            total += math.log(p)
        return total

    for x in got:
        u = next(b for a, b in rows if a == x.page_id)
        want = rule(u)
        assert (x.host, x.path) == split(u)
        assert x.rule == (want.rule if want else None)
        assert x.verdict == want.verdict if want else x.verdict in ("allow", "block")
        assert x.score == pytest.approx((logp("allow", u or "") - logp("block", u or "")) / (len(u or "") + 1), abs=1e-6)
    assert urls.judge(df.limit(0), RULES).count() == 0


def test_threshold():
    assert urls.threshold([]) == 0.0 and urls.threshold([(1.0, 3, 0)]) == 0.0
    assert -0.5 < urls.threshold([(-0.5, 0, 9), (0.7, 9, 0)]) <= 0.7


def test_toxicity(spark):
    r = random.Random(4)
    rows = [(i, prose(r, 80) + (" Idiot, scum " + " ".join(["loweiab"] * (i % 4)) if i % 5 == 0 else "")) for i in range(400)]
    docs = documents(spark, [*rows, (900, None), (901, ""), (902, "idiot"), (None, "scum idiot")])
    labels = spark.createDataFrame([(i, int(i % 5 == 0), 1) for i in range(200)] + [(0, 0, 1), (None, 1, 1), (5000, 1, 1), (7, None, 1)], "doc_id long, toxic int, text int")
    model = toxicity.fit(docs, labels)
    got = toxicity.severities(docs, model).collect()
    assert len(got) == 404
    held = [x for x in got if x.doc_id is not None and 200 <= x.doc_id < 400]
    assert all(x.toxic == (x.doc_id % 5 == 0) for x in held)
    assert {x.doc_id: x.toxic for x in got}[900] is False and {x.doc_id: x.toxic for x in got}[901] is False
    assert all(a <= b for a, b in zip(model.thresholds, model.thresholds[1:], strict=False))
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(not x.toxic for x in got)
    none = toxicity.severities(docs, toxicity.fit(docs, labels.limit(0))).collect()
    assert all(x.severity == 0 and not x.toxic for x in none)


def test_gradients_of_the_net():
    import numpy as np

    net = langid.Net(3, hidden=4)
    r = np.random.default_rng(0)
    x = r.integers(0, 256, (6, 5)).astype(np.uint8)
    there = np.arange(6)[:, None] < np.array([6, 3, 1, 6, 4])
    y = np.array([0, 1, 2, 1, 0])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}

    def loss():
        p = net.positions(x, there)
        return -(np.log(p[:, np.arange(5), y]) * there).sum() / there.sum()

    g = net.gradients(x, there, y)
    for k, v in net.p.items():
        for at in [tuple(r.integers(0, n) for n in v.shape) for _ in range(4)] + ([(int(x[0, 0]), 1)] if k.startswith("in") else []):
            old = v[at]
            v[at] = old + 1e-4
            up = loss()
            v[at] = old - 1e-4
            down = loss()
            v[at] = old
            assert g[k][at] == pytest.approx((up - down) / 2e-4, abs=2e-4)


def test_language_id(spark):
    r = random.Random(6)
    words = {"en": ["the", "and", "of", "thing"], "fr": ["le", "une", "é", "eau"], "de": ["der", "und", "ßich", "ö"]}
    rows = [(i, k, " ".join(r.choice(words[k]) for _ in range(30))) for i, k in enumerate(list(words) * 60)]
    rows += [(900, "en", None), (901, "en", ""), (902, "en", "123 !?"), (None, "en", "the and of")]
    df = spark.createDataFrame([(a, b, c, "x", 0.5) for a, b, c in rows], "doc_id long, lang string, text string, lang_pred string, score double")
    langs, net = langid.train(langid.sample(df, ~langid.held_out(F.col("doc_id"))))
    got = {x.doc_id: x for x in langid.identify(df, langs, net).collect()}
    held = [(got[i], k) for i, k, _ in rows if i is not None and i < 900 and got[i].held_out]
    assert held and sum(x.lang_pred == k for x, k in held) >= 0.95 * len(held)
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (900, 901, 902))
    assert not got[None].held_out and got[None].lang_pred in langs
    assert langid.train([]) == ([], None)
    assert all(x.lang_pred == "und" for x in langid.identify(df, [], None).collect())
