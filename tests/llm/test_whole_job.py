"""Cases in which an operator once did less than its whole job."""

import numpy as np

import corpus_pipeline
from forumlens.llm import mixing, nearcopies
from forumlens.llm.contamination import leaks, question_and_answer, shingles, words_of
from forumlens.llm.mixing import mix
from forumlens.llm.pii import KINDS, find_spans, redact, train_field
from forumlens.llm.queries import HELD_OUT
from forumlens.llm.toxicity import THRESHOLD, ToxicityModel, automaton_of, features, fit_toxicity, variants

SF = "/root/testdata/sf0.001"


def five_words(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stage_drops_near_copies_of_08(spark):
    rng = np.random.default_rng(3)
    texts = []
    for k in range(12):  # a text and copies with more and more changed words: similarity from 1 to about 0.6
        base = [f"w{x}" for x in rng.integers(0, 5000, 200)]
        for changed in range(8):
            copy = list(base)
            for j in range(changed):
                copy[10 + 20 * j] = f"new{k}x{j}"
            texts.append(" ".join(copy))
        texts.append(" ".join(base[60:]))
        texts.append(" ".join([*base, *(f"more{k}y{j}" for j in range(30))]))
    texts += [None, "", " ", "one two", "One  two"]
    sets = [five_words(t) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if (not union or len(sets[i] & sets[j]) >= 0.8 * union) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(group))


def test_mix_meets_marginals_under_the_bound(spark):
    """A source and a language of a third of all rows beside small ones; the budget is drawn in full."""
    rows = [(i, "word " * 50, ("en", "de", "fr")[i % 7 % 3], "big" if i % 3 else f"s{i % 60}", 1) for i in range(3000)]
    rows += [(9000 + i, "word " * 50, "rare", f"s{3 * (i % 3)}", 1) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    powers = {"source": 0.3, "lang": 0.3, "topic": 1.0}
    got = mix(docs, powers, budget=1.0).toPandas()
    drawn, total = got.rate * got.tokens, got.tokens.sum()
    assert got.rate.max() <= 4 and abs(drawn.sum() / total - 1) < 2e-3
    for d in ("source", "lang"):
        share = got.tokens.groupby(got[d]).sum() / total
        asked = share ** powers[d] / (share ** powers[d]).sum()
        most = 4 * share
        target, full = asked.copy(), asked > 4 * share
        while True:
            target[full] = most[full]
            target[~full] = asked[~full] * (1 - most[full].sum()) / asked[~full].sum()
            if not (more := ~full & (target > most)).any():
                break
            full |= more
        assert ((drawn.groupby(got[d]).sum() / total / target - 1).abs() < 5e-3).all(), d
    lacking = got[got.unmet > 0]
    assert set(lacking.lang) == {"rare"} and (abs(lacking.unmet - (1 - 4 * 4 / 3004 / asked["rare"])) < 2e-3).all()


def test_field_keeps_what_stands_beside_base_spans():
    texts = ["0171-5550199 +49 30 901820", "ops@build-host7 sales@example.com", "a@b.de max@host7 c@d.de ops@build-host7"]
    got = [[(KINDS[k], t[s:e]) for s, k, e in spans] for t, spans in zip(texts, find_spans(texts, train_field()), strict=True)]
    assert got[0] == [("crf_phone", "0171-5550199"), ("phone", "+49 30 901820")]
    assert got[1] == [("crf_email", "ops@build-host7"), ("email", "sales@example.com")]
    assert got[2] == [("email", "a@b.de"), ("crf_email", "max@host7"), ("email", "c@d.de"), ("crf_email", "ops@build-host7")]


def test_signs_and_ones_are_read_as_letters():
    for token, word in {"$tupid": "stupid", "l0$er": "loser", "a$$": "ass", "a$$!": "ass", "1oser": "loser", "1d1ot": "idiot", "s1l1y": "silly", "＄tupid": "stupid"}.items():
        assert word in variants(token), token
    assert variants("stupid!") == ["stupid"] and variants("plain") == ["plain"]
    found = automaton_of(ToxicityModel(((" stupid ", 2.0), (" loser ", 1.0), (" trash ", 1.0))))
    plain = features("you stupid loser and trash", found)
    assert features("you $tupid 1o$er and trash$$", found) == plain and features("you $tupid l0$er and trash!", found)[0] == plain[0]
    assert features("a tr@sh can and no l0$er bracket", found)[0] == 0.0 and features(None, found) == (0.0, 0.0)


def grouped(texts, least=0.8):
    """Smallest index of each text's group, by comparing all sets."""
    sets, group = [five_words(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if (not union or len(sets[i] & sets[j]) >= least * union) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def test_large_families_lose_no_link(spark, monkeypatch):
    """Hundreds of texts that are alike but below 0.8, links between some of them, and a hub that links others."""
    monkeypatch.setattr(nearcopies, "BLOCK_ROWS", 64)
    monkeypatch.setattr(nearcopies, "ROWS_PER_TASK", 50)
    rng = np.random.default_rng(11)
    base = [f"w{x}" for x in rng.integers(0, 9000, 300)]

    def changed(words, n, mark):
        words = list(words)
        for j in rng.choice(len(words), n, replace=False).tolist():
            words[j] = f"{mark}x{j}"
        return words

    alike = [changed(base, 10, f"a{k}") for k in range(220)]
    texts = [" ".join(w) for w in alike] + [" ".join(changed(alike[k], 2, f"b{k}")) for k in range(0, 220, 20)]
    hub = [f"h{x}" for x in rng.integers(0, 9000, 300)]
    texts += [" ".join(changed(hub, 5, f"c{k}")) for k in range(60)] + [" ".join(hub)]
    docs = spark.createDataFrame([(i, t, f"text {i}", i % 3) for i, t in enumerate(texts)], "doc_id long, text string, _node string, _row int")
    kept = nearcopies.keep_one_of_near_copies(docs)
    want = sorted(set(grouped(texts)))
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows) == want and 180 < len(want) < 240
    assert all(r["_node"] == f"text {r['doc_id']}" and r["_row"] == r["doc_id"] % 3 for r in rows) and kept.columns == docs.columns


def test_run_against_plain_python(spark, tmp_path):
    """Stage after stage over planted rows, each against its own plain form, and ``run`` as a whole."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rng = np.random.default_rng(12)
    prose = lambda n: " ".join(f"p{x}" for x in rng.integers(0, 3000, n))
    near = [prose(120) for _ in range(6)]
    planted = [(100_000 + i, t) for i, t in enumerate(near)] + [(100_010 + i, t) for i, t in enumerate(near[:3])]
    planted += [(100_020 + i, " ".join([*t.split()[:-2], "other", "end"])) for i, t in enumerate(near)]
    planted += [(100_030 + i, f"{prose(30)} {t} {prose(30)}") for i, t in enumerate(items[:5])]
    planted += [(100_040, f"{prose(40)} mail a.b{1}@example.com or +1 (017) 555-7713 {prose(20)}"), (100_041, None), (100_042, "")]
    more = spark.createDataFrame([(i, t, "en", "planted", None if t is None else len(t)) for i, t in planted], docs.schema)
    docs.unionByName(more).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()}

    whole = spark.read.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(f"not ({HELD_OUT})").select("doc_id", "toxic")
    model = fit_toxicity(whole, labels)
    found = automaton_of(model)
    score = lambda t: 1 / (1 + np.exp(-(model.bias + np.dot(features(t, found), model.slopes))))
    clean = sorted(i for i, r in rows.items() if score(r["text"]) < THRESHOLD)
    stages = dict(corpus_pipeline.STAGES)
    after = stages["toxicity"](spark, whole, str(tmp_path))
    assert sorted(r["doc_id"] for r in after.collect()) == clean

    group = grouped([rows[i]["text"] for i in clean])
    single = sorted({clean[g] for g in group})
    after = spark.createDataFrame(stages["simhash_near_dedup"](spark, after, str(tmp_path)).collect(), docs.schema)
    assert sorted(r["doc_id"] for r in after.collect()) == single and not any(100_010 <= i < 100_030 for i in single)

    parts = [question_and_answer(t) for t in items]

    def leaky(text):
        have = shingles(words_of(text))
        share = lambda words: len(shingles(words) & have) / max(1, len(shingles(words))) if words else 1.0
        return any(leaks(share(q), share(a), share(words_of(t)), 0.8) for t, (q, a) in zip(items, parts, strict=True))

    free = [i for i in single if not leaky(rows[i]["text"])]
    after = spark.createDataFrame(stages["benchmark_decontamination"](spark, after, str(tmp_path)).collect(), docs.schema)
    assert sorted(r["doc_id"] for r in after.collect()) == free and not any(100_030 <= i < 100_035 for i in free)

    field = train_field()
    texts = {i: rows[i]["text"] for i in free}
    spans = dict(zip(texts, find_spans([t or "" for t in texts.values()], field), strict=True))
    masked = {i: t and redact(t, spans[i]) for i, t in texts.items()}
    after = spark.createDataFrame(stages["personal_data"](spark, after, str(tmp_path)).collect(), docs.schema)
    assert {r["doc_id"]: r["text"] for r in after.collect()} == masked and "<EMAIL> or <PHONE>" in masked[100_040]

    want = stages["source_mixing"](spark, after, str(tmp_path)).select("doc_id", "text", "copies").collect()
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "text", "copies").collect()
    key = lambda r: (r[0], r[1] or "", r[2])
    assert sorted(map(key, got)) == sorted(map(key, want)) and len(got) > len(free) / 3


def test_near_copies_are_dealt_in_shares_and_lose_nothing(spark, monkeypatch):
    """Cells and sets are shuffled a share at a time, each far below the whole, with the same rows as in one go."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 60 if i % 3 else 9000, 40)) for i in range(60)]
    texts += [f"{t} tail" for t in texts[:30]] + texts[10:20] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(set(grouped([t or "" for t in texts])))
    written, save = {}, nearcopies.Scratch.save

    def spied(self, df, name):
        out = save(self, df, name)
        written[name] = out.count() if "crowd" in name else 0
        return out

    monkeypatch.setattr(nearcopies.Scratch, "save", spied)
    assert sorted(r["doc_id"] for r in nearcopies.keep_one_of_near_copies(docs).collect()) == want
    shares = [n for name, n in written.items() if name.startswith("crowd-share")]
    assert sum(shares) == written["crowd"] > 0 and max(shares) < written["crowd"] / 2
    assert {"stars-share3", "others-share3", "rest-share3"} <= set(written)
    monkeypatch.setattr(nearcopies, "BANDS_AT_ONCE", nearcopies.BANDS)
    monkeypatch.setattr(nearcopies, "SHARES", 1)
    assert sorted(r["doc_id"] for r in nearcopies.keep_one_of_near_copies(docs).collect()) == want


def test_most_texts_that_stay_are_not_shuffled(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scratch = nearcopies.Scratch(spark, "lie")
        marked = scratch.save(spark.range(4000).selectExpr("id as _row", "repeat('a', 100) as text"), "marked")
        dropped = spark.createDataFrame([(r,) for r in (0, 5, 3999)], "_row long")
        for slots in (nearcopies.SLOTS, 8, 1):  # few slots: most rows share one with a dropped row
            rows = nearcopies.without_rows(marked, dropped, nearcopies.Scratch(spark, "lie"), slots)
            assert {r["_row"] for r in rows.select("_row").collect()} == set(range(4000)) - {0, 5, 3999}
        whole = nearcopies.without_rows(marked, dropped, nearcopies.Scratch(spark, "lie"))
        plan = whole._jdf.queryExecution().executedPlan().toString()
        first = plan[: plan.index("SortMergeJoin")]  # the side of the union that holds all rows without a slot in common
        assert "LeftAnti" in first and "hashpartitioning" not in first
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_plans_of_raking_do_not_grow_with_dimensions(spark, monkeypatch):
    sizes, save = [], mixing.Scratch.save

    def spied(self, df, name):
        sizes.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join"))
        return save(self, df, name)

    monkeypatch.setattr(mixing.Scratch, "save", spied)
    docs = spark.createDataFrame([(i, "word " * (1 + i % 7), f"s{i % 3}", f"l{i % 2}") for i in range(60)], "doc_id long, text string, source string, lang string")
    assert mixing.mix(docs, {"source": 0.5, "lang": 0.7}).count() == 60
    assert max(sizes) <= 3
