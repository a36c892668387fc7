"""Archive, word runs and hard negatives against plain Python, on given rows and on odd ones."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from forumlens.llm import negatives
from forumlens.llm.negatives import Vectors, angles_to, directions, hard_negatives, scores, window_bounds
from forumlens.llm.queries import QUERIES
from forumlens.llm.warc import header_field, page_of, read_archive, write_archive, write_warc
from forumlens.llm.wordruns import as_runs, periodic_runs, runs_in, text_runs, zones

SF = "/root/testdata/sf0.001"


# ---- archive -------------------------------------------------------------------------------
PAGES = "page_id long, url string, html string, row string, slices string, payload string, header string, payload_digest string"


@pytest.fixture(scope="module")
def pages(spark):
    hot, small = "<p>é</p>" * 40, "tiny"
    rows = [(i, f"http://h/{i}", hot if i % 3 == 0 else small if i % 50 == 1 else f"<p>{i}</p>" * 30) for i in range(4000)]
    rows += [(7000, None, None), (7001, "http://h/\r\nWARC-Type: revisit", ""), (None, "no id", hot), (None, "no id", "only here " * 20), (None, "no id", "only here " * 20)]
    rows += [(5, "http://h/again", hot), (8000, "twice", "same " * 50), (8000, "twice", "same " * 50), (8001, "long", "\r\n\r\n x" * 200_000)]
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], PAGES)


def test_archive_round_trip(spark, pages, tmp_path):
    write_archive(pages.repartition(5), str(tmp_path / "archive"))
    got = read_archive(spark, str(tmp_path / "archive")).select("*", page_of(header_field(F.col("header"), "WARC-Record-ID")).alias("named")).collect()
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    assert sorted((r["page_id"] or -1, bytes(r["payload"])) for r in got) == sorted((i or -1, p) for i, p in rows)
    first = {}
    for i, p in rows:
        first[p] = min(first.get(p, 10**9), i if i is not None else 10**8)
    responses = {}
    for r in got:
        payload, record = bytes(r["payload"]), bytes(r["record"])
        assert r["named"] == r["page_id"] and record.startswith(bytes(r["header"]))
        names, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in names.decode().split("\r\n")[1:])
        assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest() and int(fields["Content-Length"]) == len(rest)
        assert fields["WARC-Type"] == r["record_type"] and ("WARC-Refers-To" in fields) == (r["record_type"] == "revisit")
        http, _, body = rest.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n") and body == (payload if r["record_type"] == "response" else b"")
        if r["record_type"] == "response":
            responses.setdefault(payload, []).append(r["page_id"])
        else:
            assert r["refers_to"] == (first[payload] if first[payload] < 10**8 else None)
    assert all(len(ids) == 1 and (ids[0] is None or ids[0] == first[p]) for p, ids in responses.items() if len(p) >= 100)
    assert len(responses[b"tiny"]) == sum(p == b"tiny" for _, p in rows) and len(responses[b""]) == 2
    stored = spark.read.parquet(str(tmp_path / "archive/payloads"))
    assert stored.count() == len(set(p for _, p in rows))
    assert 1 < stored.agg(F.max("slices")).first()[0] <= 1000 and stored.where("slices = 1").count() > 2000


def test_archive_as_warc_files(spark, pages, tmp_path):
    write_archive(pages, str(tmp_path / "archive"))
    write_warc(read_archive(spark, str(tmp_path / "archive")), str(tmp_path / "warc"))
    n = 0
    for file in (tmp_path / "warc").glob("part-*"):
        data, at = file.read_bytes(), 0
        while at < len(data):
            head = data.index(b"\r\n\r\n", at) + 4
            size = int(re.search(rb"\r\nContent-Length: (\d+)\r\n", data[at:head])[1])
            assert data[at : at + 10] == b"WARC/1.1\r\n" and data[head + size : head + size + 4] == b"\r\n\r\n"
            at, n = head + size + 4, n + 1
    assert n == pages.count()


def test_archive_empty_and_damaged(spark, pages, tmp_path):
    write_archive(pages.limit(0), str(tmp_path / "none"))
    assert read_archive(spark, str(tmp_path / "none")).count() == 0
    write_archive(pages.limit(20), str(tmp_path / "some"))
    stored = spark.read.parquet(str(tmp_path / "some/payloads"))
    damaged = stored.withColumn("payload", F.concat("payload", F.lit(b"x"))).toPandas()
    spark.createDataFrame(damaged, stored.schema).write.mode("overwrite").parquet(str(tmp_path / "some/payloads"))
    with pytest.raises(Exception, match="damaged payload"):
        read_archive(spark, str(tmp_path / "some")).select("payload").collect()


# ---- word runs -----------------------------------------------------------------------------
def plain_runs(words: list, least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) by comparing the words at every distance."""
    codes, found = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if words else np.empty(0, int), []
    for q in range(1, len(words) // times + 1):
        same = codes[q:] == codes[:-q]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(int), [0]]))).reshape(-1, 2)
        for s, e in edges.tolist():
            n = e - s + q
            smaller = any(q % d == 0 and (codes[s + d : s + n] == codes[s : s + n - d]).all() for d in range(1, q))
            if n >= max(least, times * q) and not smaller:
                found.append((s, n, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_are_all_found():
    rng = np.random.default_rng(3)
    for _ in range(1500):
        n, k = int(rng.integers(0, 60)), int(rng.integers(1, 6))
        words = rng.integers(0, k, n).tolist()
        if n > 10 and rng.random() < 0.5:
            a, p = int(rng.integers(0, n)), int(rng.integers(1, 8))
            words = [words[i] if i < a else words[a + (i - a) % p] if a + (i - a) % p < n else 0 for i in range(n)]
        assert runs_in(words) == sorted(plain_runs(words, 2, 2))
        found, kept = text_runs(" ".join(map(str, words)).encode())
        assert found == plain_runs(words, 6, 4)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        assert kept.split() == [str(w).encode() for i, w in enumerate(words) if i not in gone]
        spans = zones(np.array(words, np.int64)) if words else []
        assert all(any(a <= s and s + m <= b for a, b in spans) for s, m, _ in found)


def test_runs_of_odd_texts(spark):
    texts = [None, "", " \t\n\x0b\f\r ", "a a " * 6, "a " * 5, "x y " * 100_000, "same same", "same same"]
    rows = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, found string")
    got = {r["doc_id"]: r for r in rows.select("doc_id", periodic_runs(F.col("text")).alias("f")).select("doc_id", as_runs(F.col("f")).alias("runs"), "f.kept").collect()}
    assert [len(got[i]["runs"]) for i in range(8)] == [0, 0, 0, 1, 0, 1, 0, 0]
    assert tuple(got[3]["runs"][0]) == (0, 6, 1) and tuple(got[5]["runs"][0]) == (0, 200_000, 2)
    assert bytes(got[5]["kept"]) == b"x y" and bytes(got[4]["kept"]) == b"a a a a a" and bytes(got[0]["kept"]) == b""
    assert rows.limit(0).select(periodic_runs(F.col("text")).alias("f")).count() == 0


def test_word_runs_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op12_word_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs) and sum(r["n_runs"] for r in got.values()) > 5
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for doc in docs:
        words, h = re.findall(r"[^\x20\x09-\x0D]+", doc["text"] or ""), zlib.crc32(str(doc["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = plain_runs(words, 6, 4)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        best = min(found, key=lambda r: (-r[1] * 10**9 // r[2], r[0], r[2]), default=(None, None, None))
        row = got[doc["doc_id"]]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(found), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert row["runs_sha256"] == digest("".join(f"{s},{m},{q}\n" for s, m, q in found))
        assert row["collapsed_sha256"] == digest(" ".join(w for i, w in enumerate(words) if i not in gone))


# ---- hard negatives ------------------------------------------------------------------------
VECTORS = "vec_id long, embedding array<double>, label long, row long, score string, anchor string, slot int, near string"


def plain_negatives(rows: list[tuple]) -> set[tuple]:
    good = [(i, np.floor(256 * np.array(v, float)).astype(object), k) for i, v, k in rows if i is not None and k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for n, (a, x, k) in enumerate(good):
        if a % 100:
            continue
        scored = sorted((-int(sum(x * y)), i, lab, m) for m, (i, y, lab) in enumerate(good) if m != n and len(y) == len(x))
        for s, p, _, m in [r for r in scored if r[2] == k][:5]:
            fits = [r for r in scored if r[2] != k and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out |= {(n, a, m, p, rank, r[1], -s, -r[0]) for rank, r in enumerate(fits, 1)}
    return out


def test_hard_negatives(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 12))
    rows = [(i, (centres[i % 6] + 0.3 * rng.standard_normal(12)).tolist(), int(rng.integers(0, 3))) for i in range(900)]
    rows += [(i, centres[0].tolist(), i % 2) for i in range(1000, 1400)]  # many ties
    rows += [(i, [0.0] * 12, 1) for i in (2000, 2001)] + [(i, [1.0, -2.0, 0.5], i % 3) for i in range(2100, 2112)]
    rows += [(3000, None, 1), (3100, [None] * 12, 1), (3200, [float("nan")] * 12, 1), (3300, [1.0] * 12, None), (None, [1.0] * 12, 1), (3400, [], 1), (3401, [], 2)]
    rows += [(100, rows[100][1], rows[100][2]), (50, rows[50][1], rows[50][2])]
    table = spark.createDataFrame([(*r, 1, "s", "a", 2, "n") for r in rows], VECTORS).repartition(3)
    got = hard_negatives(table).toPandas()
    want = plain_negatives(rows)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got[columns].astype(int).to_numpy().tolist())) == sorted((a, p, k, n, s, t) for _, a, _, p, k, n, s, t in want)
    assert len(got) > 200 and hard_negatives(table.limit(0)).count() == 0


def test_few_windows_are_scored(monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((16, 32)) * 3
    ints = np.floor(256 * (centres[np.arange(4096) % 16] + 0.2 * rng.standard_normal((4096, 32)))).astype(np.int32)
    norm = np.linalg.norm(ints.astype(float), axis=1)
    angles = angles_to(ints, norm, directions(ints[:500].astype(float)))
    order = np.lexsort((angles.min(1), angles.argmin(1)))
    rows = Vectors(np.arange(4096), np.arange(4096), np.arange(4096) % 7, ints, norm, angles)[order]
    some = rows[::512]
    starts = np.arange(0, 4096, negatives.WINDOW_ROWS)
    least, most = window_bounds(some, rows, starts)
    exact = scores(some.ints, rows.ints)
    window = np.arange(4096) // negatives.WINDOW_ROWS
    assert (exact >= least[:, window]).all() and (exact <= most[:, window]).all()
    scored = []
    monkeypatch.setattr(negatives, "scores", lambda a, b: scored.append(len(a) * len(b)) or scores(a, b))
    best = np.sort(exact, axis=1)[:, -40][:, None]
    found = negatives.search(some, rows, best, np.full_like(best, 1 << 62), True, 5)
    assert len(found) and sum(scored) < len(some.row) * 4096 / 2


def test_scores_are_exact():
    big = np.array([[negatives.LARGEST] * 100], np.int32)
    assert int(scores(big, big)[0, 0]) == 100 * negatives.LARGEST**2 and int(scores(big[:, :1], -big[:, :1])[0, 0]) == -(negatives.LARGEST**2)


