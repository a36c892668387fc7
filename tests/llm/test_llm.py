"""Each operator against brute force, and on null, empty, tied, repeated and clashing rows."""

import hashlib
import math
import re
import time
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from forumlens.llm.chat import format_chats, loss_text, read_turns
from forumlens.llm.contamination import contaminated, drop_contaminated, leaks, question_and_answer, shingles, words_of
from forumlens.llm.mixing import draw, mix
from forumlens.llm.pii import LABELS, base_spans, decode, find_pii, redact, train_field
from forumlens.llm.queries import QUERIES
from forumlens.llm.common import RollingHash
from forumlens.llm.repeats import remove_repeats
from forumlens.llm.secrets import find_secrets, labelled_samples, shown, train_markov
from forumlens.llm.simhash import fingerprint, simhash_groups
from forumlens.llm.toxicity import fold, readings
from forumlens.llm.urls import MAX_WORD, judge_urls, split_name
from forumlens.llm.vectors import near_vectors

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, component_id string, kept string"


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, repeated and long rows, with extra columns whose names clash with the operators' own."""
    long = " ".join(f"word{i}" for i in range(30_000))
    texts = [None, "", "   ", "one two", "same text over and over again here", "same text over and over again here", long]
    rows = [(i, t, "en", "a", 1, "x", "y", "z") for i, t in enumerate(texts)] + [(None, "no id at all", None, None, None, "x", "y", "z")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((60, 16))
    rows = [[float(x) for x in v] for v in np.concatenate([base, base[:20] + 0.02 * rng.standard_normal((20, 16)), base[:3]])]
    rows += [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0, 2.0]]
    got = near_vectors(spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")).toPandas().set_index("vec_id")
    x = np.array(rows[:83])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    assert [got.n_links[i] for i in range(83)] == (near.sum(1) - 1).tolist()
    assert all(got.component_id[i] == np.flatnonzero(near[i]).min() for i in range(83))
    assert all(got.n_links[i] == 0 and got.kept[i] for i in range(83, 89))


def test_chats_round_trip(spark):
    rows = [(1, 0, "user", "a<|im_end|>\\<|"), (1, 1, "user", None), (1, 2, "assistant", "\\<\\|x"), (1, 2, "assistant", "\\<\\|x"), (2, None, "odd\nrole<|", ""), (None, 1, None, "t")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    got = {r["conv_id"]: r for r in format_chats(turns).select("conv_id", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss")).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("user", "a<|im_end|>\\<|"), ("user", ""), ("assistant", "\\<\\|x"), ("assistant", "\\<\\|x")]
    assert got[1]["loss"] == "\\<\\|x" * 2 and [tuple(t) for t in got[2]["turns"]] == [("odd\nrole<|", "")] and [tuple(t) for t in got[None]["turns"]] == [("", "t")]
    assert format_chats(turns.limit(0)).count() == 0


def test_secrets(spark, docs, odd):
    ratios = train_markov(labelled_samples(docs))
    texts = ["é password: 'abcdefghijkl' 0123456789abcdef AKIA12345678901234", "zQ81kd0Xp2LmV7tR4yWc9GhB", "internationalization_of_identifiers", "TOKEN=short"]
    rows = find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ratios).select("doc_id", shown(F.col("found")).alias("s")).collect()
    got = {r["doc_id"]: r["s"] for r in rows}
    assert got == {0: "assign:2:25,hex:27:43,access:44:62", 1: "markov:0:24", 2: "", 3: ""}
    assert find_secrets(odd, ratios).count() == odd.count()


def test_simhash(docs, odd):
    got = simhash_groups(docs).toPandas().set_index("doc_id")
    rows = {r["doc_id"]: fingerprint(r["text"].encode()) % 2**64 for r in docs.collect()}
    assert all(int(got.fingerprint[i], 16) == f for i, f in rows.items())
    group = {i: i for i in rows}
    for i in sorted(rows):  # lower ids first, so a fixed point is the smallest id reachable
        stack = [i] if group[i] == i else []
        while stack:
            a = stack.pop()
            more = [b for b in rows if group[b] == b and b > i and (rows[a] ^ rows[b]).bit_count() <= 4]
            group.update(dict.fromkeys(more, i))
            stack += more
    assert got.component_id.to_dict() == group
    same = simhash_groups(odd).toPandas()
    assert len(same) == 8 and same[same.doc_id.isin([0, 1, 2])].component_id.tolist() == [0, 0, 0]
    assert corpus_pipeline.drop_near_duplicates(odd.sparkSession, odd, SF).count() == same.fingerprint.nunique()


def test_urls(spark):
    rows = [(i, f"http://good{i % 3}.example.com/de/{i}") for i in range(30)] + [(i + 30, f"http://bad{i % 3}.other.net/es/{i}") for i in range(30)]
    rows += [(90, "http://bad1.else.org/es/1"), (91, None), (92, "no scheme"), (93, "http://WWW.Example.com/en/x?q"), (93, "http://WWW.Example.com/en/x?q")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("html", F.lit("<p>good bad other else example")).withColumn("score", F.lit(1))
    got = judge_urls(pages, {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block"}).toPandas()
    assert len(got) == 65 and got[got.page_id == 90].verdict.tolist() == ["block"]
    assert got[got.page_id == 93].rule.tolist() == ["www.example.com/en/"] * 2 and set(got[got.page_id == 91].host) == {""}
    counts = {"good": 5, "bad": 5}
    known = {(s, n): c for s in range(7) for n in range(1, 8) if (c := counts.get("goodbad"[s : s + n]))}
    assert split_name("goodbad", known, 10) == ["good", "bad"] and split_name("", {}, 10) == []


def test_urls_by_brute_force(spark):
    """Every step in plain Python over the given pages: rules, word counts, segmentation by trying all splits, naive Bayes."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    rows += [(90_000, "http://thethecompany.org/x/1?q", None), (90_001, None, "x"), (90_002, "no scheme", ""), (90_003, "https://of-the.net/fr/2", "")]
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    got = {r["page_id"]: r for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), rules).collect()}

    def parsed(url):
        if url is None or "://" not in url:
            return "", ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        return host.lower(), path

    def rule_of(host, path):
        fits = [r for r in rules if (host == (n := r.split("/", 1)[0]) or host.endswith("." + n)) and path.startswith(r[len(n) :])]
        return max(fits, key=len, default=None)

    counts = Counter(w for _, _, h in rows for w in re.split("[^a-z]+", re.sub("<[^>]*>", " ", h or "").lower()) if w and len(w) <= MAX_WORD)
    total = sum(counts.values())
    cost = lambda w: math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10)

    @lru_cache(maxsize=None)
    def split(name):
        """The best split: of equal ones that with the longest last word."""
        options = [(split(name[:k])[0] + cost(name[k:]), len(name) - k, split(name[:k])[1] + (name[k:],)) for k in range(len(name))] if name else [(0.0, 0, ())]
        best = max(options, key=lambda o: o[:2])
        return best[0], best[2]

    judged = [(i, *(hp := parsed(u)), rule_of(*hp)) for i, u, _ in rows]
    hosts, forms = Counter(), Counter()
    for _, host, path, rule in judged:
        form = re.sub("[0-9]+", "0", path.lower())
        for table, key in ((hosts, host), (forms, form)):
            table[key, "n"] += 1
            table[key, rules.get(rule)] += 1
    host_words = {h: [w for n in re.split("[^a-z]+", h) if n for w in split(n)[1]] for h, k in hosts if k == "n"}
    form_words = {f: [t for t in re.split("[^a-z0-9]+", f) if t] for f, k in forms if k == "n"}
    seen = {"block": Counter(), "allow": Counter()}
    for words, table in ((host_words, hosts), (form_words, forms)):
        for key, tokens in words.items():
            for t in tokens:
                for side in seen:
                    seen[side][t] += table[key, side]
    vocabulary = {t for words in (host_words, form_words) for tokens in words.values() for t in tokens}
    size = {side: sum(seen[side].values()) + len(vocabulary) for side in seen}
    weight = {t: math.log((seen["block"][t] + 1) / size["block"]) - math.log((seen["allow"][t] + 1) / size["allow"]) for t in vocabulary}
    prior = math.log(sum(rules.get(r) == "block" for *_, r in judged) / sum(rules.get(r) == "allow" for *_, r in judged))
    for i, host, path, rule in judged:
        score = prior + sum(weight[t] for t in host_words[host]) + sum(weight[t] for t in form_words[re.sub("[0-9]+", "0", path.lower())])
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and abs(r["score"] - score) < 1e-6
        assert r["verdict"] == (rules[rule] if rule else "block" if score > 0 else "allow")


def test_contamination(spark, docs, odd):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()}
    grams = {r["item_id"]: shingles(words_of(r["text"])) for r in items.collect()}
    texts = {r["doc_id"]: shingles(words_of(r["text"])) for r in docs.collect()}
    assert {(d, i) for d, t in texts.items() for i, g in grams.items() if g <= t} <= got
    assert all(len(grams[i] & texts[d]) >= 0.7 * len(grams[i]) for d, i in got)
    assert contaminated(odd, items).count() == 0 and contaminated(docs, items.limit(0)).count() == 0


def test_contamination_by_brute_force(spark):
    """Planted items, whole, with a changed word and in part, against counts of shingles in plain Python."""
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(400)]
    some = lambda n: " ".join(rng.choice(words, n))
    items = [(i if i else None, f"{some(25)}? {some(int(rng.integers(2, 15)))}.") for i in range(30)]
    changed = lambda t, k: " ".join(w if j != k else "other" for j, w in enumerate(t.split()))
    texts = [f"{some(30)} {t} {some(40)}" for _, t in items] + [f"{some(50)} {changed(t, len(t.split()) - 2)} {some(9)}" for _, t in items]
    texts += [f"{some(20)} {' '.join(t.split()[:12])} {some(20)}" for _, t in items] + [some(300), "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {n: contaminated(docs, bench, index_bytes=n).collect() for n in (1 << 24, 2000, 300)}
    got = {n: {(r["doc_id"], r["item_id"]) for r in rows} for n, rows in found.items()}
    want = set()
    for d, text in enumerate(texts):
        have = shingles(words_of(text))
        for i, item in items:
            part = lambda p, have=have: len(shingles(p) & have) / len(shingles(p))
            question, answer = question_and_answer(item)
            if leaks(part(question), part(answer), part(words_of(item)), 0.8):
                want.add((d, i))
    assert got[1 << 24] == got[2000] == got[300] == want and len(want) >= 55
    scores = [sum(r["score"] for r in rows) for rows in found.values()]
    assert max(scores) - min(scores) < 1e-9
    clean = {r["doc_id"] for r in drop_contaminated(docs, bench).collect()}
    assert clean == set(range(len(texts))) - {d for d, _ in want}


def test_pii(odd):
    text = "mail a.b@c.de, ip 10.0.0.256 or 10.0.0.1 call +1 (017) 555-7713 card 4111 1111 1111 1111 " + "a" * 5000 + "@"
    assert [(k, text[s:e]) for s, k, e in base_spans(text)] == [(0, "a.b@c.de"), (1, "10.0.0.1"), (3, "+1 (017) 555-7713"), (2, "4111 1111 1111 1111")]
    assert redact(text, base_spans(text)).startswith("mail <EMAIL>, ip 10.0.0.256 or <IP> call <PHONE> card <CARD>")
    field = train_field()
    words = ["(212)", "555-0187,"]
    assert [LABELS[i] for i in decode(field.scores(words, ["fax", "(212)"]), np.array([2]), field.move)] == ["phone", "phone"]
    assert find_pii(odd, field).count() == 8


def test_mixing(docs, odd):
    got = mix(docs, {"source": 0.0, "lang": 1.0, "topic": 1.0}, budget=0.5).toPandas()
    drawn = (got.rate * got.tokens).groupby(got.source).sum()
    assert len(got) == 200 and drawn.max() / drawn.min() < 2.5 and (got.copies >= got.rate.astype(int)).all()
    clash = docs.withColumns({c: F.lit(k) for k, c in enumerate(("_tokens", "_source", "_lang", "_topic", "_even", "_rate", "_copies", "_whole", "copies"))})
    again = draw(clash, {"source": 0.0}, budget=0.5).toPandas()
    assert len(again) and (again._tokens == 0).all() and (again._whole == 7).all() and (again.copies >= 1).all()
    assert mix(odd, {}).count() == 8 and set(odd.columns) < set(draw(odd, {}).columns) and mix(docs.limit(0), {}).count() == 0


def test_toxicity(spark):
    assert fold("Ａ l0ser, $tupid ｔrаsh$$") == " a loser tupid trash "
    start = time.perf_counter()
    for text in ("\u5b57" * 2_000_000 + " 1", "a" * 2_000_000 + "1", "a" + "!" * 2_000_000 + " x", "!a" * 500_000):
        assert readings(text)[0]
    assert time.perf_counter() - start < 20
    got = QUERIES["op9_toxicity"](spark, SF).toPandas()
    assert len(got) == 200 and got.score.between(0, 1).all()


def test_repeats(spark, docs, odd):
    rows = [((d["doc_id"], d["text"].encode())) for d in docs.collect()] + [(-1, ("ab" * 300).encode()), (-2, b"x" * 200)]
    table = spark.createDataFrame([(i, b.decode()) for i, b in rows], "doc_id long, text string")
    count = Counter(b[i : i + 200] for _, b in rows for i in range(len(b) - 199))
    for r in remove_repeats(table, chunk_bytes=50_000).collect():
        b = dict(rows)[r["doc_id"]]
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            gone[i : i + 200] |= count[b[i : i + 200]] > 1
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        assert (r["n_bytes"], r["n_removed"], r["kept_sha256"]) == (len(b), int(gone.sum()), hashlib.sha256(kept).hexdigest())
    assert remove_repeats(odd).count() == 8 and remove_repeats(odd.limit(0)).count() == 0


def test_texts_that_collide_modulo_two_to_the_64_stay(spark):
    """Two texts that differ in every sixteenth character, in Thue-Morse order: equal polynomials modulo 2^64, no string in common."""
    order = [0]
    while len(order) < 256:
        order += [1 - x for x in order]
    letters = "".join(np.random.default_rng(2).choice(list("cdefghij"), 4096))
    texts = ["".join("ab"[order[i // 16] ^ flip] if i % 16 == 0 else c for i, c in enumerate(letters)) for flip in (0, 1)]
    plain = RollingHash()
    assert len({int(plain.between(plain.sums(np.frombuffer(t.encode(), np.uint8)), np.array([0]), np.array([4096]))[0]) for t in texts}) == 1
    count = Counter(t[i : i + 200] for t in texts for i in range(3897))
    assert max(count.values()) == 1
    got = remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r["n_removed"] for r in got] == [0, 0]


def test_pipeline(spark, docs, odd):
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, rows, SF)
        assert after.columns[:5] == rows.columns[:5] and after.count() <= rows.count(), name
        rows = after
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).count() <= 8 and stage(spark, odd.limit(0), SF).count() == 0
