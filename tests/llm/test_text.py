"""Mixing, packing, formatting, extraction and quality on awkward rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chatloom.llm import chat_format, html_extract, line_dedup, mixing, packing, quality
from chatloom.llm.queries import tokenizer_path

from llm_rows import AWKWARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size(text):
    return len(WORD.findall(text or ""))


def targets_model(sizes, weights, most):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in capped else share[s] for s in order}
        capped |= over


def test_mixing(make_docs, none):
    rows = [(i, "w " * (20 + i % 90), f"s{i % 5}" if i % 11 else None) for i in range(600)]
    rows = [r for r in rows if r[2] != "s3" or r[0] < 30] + list(AWKWARD)
    docs = make_docs(rows)
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert len(got) == len(rows)
    source = [(r[2] if len(r) > 2 else "web") for r in rows]
    sizes = Counter()
    for r, s in zip(rows, source, strict=True):
        sizes[s] += size(r[1])
    want = targets_model(sizes, (5, 2, 1), 3)
    assert {round(r.target, 6) for r in got} == {round(t, 6) for t in want.values()}
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    by_target = Counter()
    for r in got:
        by_target[(r.source_size, round(r.target, 6))] += r.taken
    for (_, target), taken in by_target.items():
        assert abs(taken - target) <= 64 + 0.002 * target
    assert Counter(got) == Counter(mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect())
    assert mixing.mix(none).count() == 0
    assert mixing.mix(make_docs([(1, None), (2, " ")])).agg(F.sum("taken")).first()[0] == 0


def test_mixed_documents_hold_the_words(make_docs):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(10 + i % 70)), f"s{i % 4}") for i in range(300)]
    docs = make_docs(rows)
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    words = Counter()
    for r in mixing.mixed_documents(docs).collect():
        own = r.text.split()
        assert set(own) <= set(rows[r.doc_id][1].split()) and r.n_chars == len(r.text)
        words[r.doc_id] += len(own)
    assert words == Counter({i: n for i, n in taken.items() if n})


def seats_model(votes, seats, most):
    out = [0] * len(votes)
    for _ in range(seats):
        open_ = [i for i in range(len(votes)) if out[i] < most[i] and votes[i] > 0]
        if not open_:
            break
        best = max(open_, key=lambda i: votes[i] / (2 * out[i] + 1))
        out[best] += 1
    return out


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 997])
def test_seats(spark, seats):
    votes = [50.3, 20.1, 11.7, 3.3, 0.9, 0.0, 14.2]
    rows = [(i, v, seats, 10**6) for i, v in enumerate(votes)]
    df = spark.createDataFrame(rows, "party int, votes double, seats long, most long")
    got = {r.party: r.won for r in mixing.sainte_lague(df, [], "votes", "seats", "most", "won").collect()}
    assert [got[i] for i in range(len(votes))] == seats_model(votes, seats, [10**6] * len(votes))


def test_packing(awkward, none):
    from tokenizers import Tokenizer

    got = packing.pack_documents(awkward, tokenizer_path()).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for row in AWKWARD:
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 1]
        want[(row[0], len(ids))] += len(ids)
        for r in got:
            if r.doc_id == row[0] and r.doc_tokens == len(ids) and row[0] not in (9, None):
                piece = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
                assert r.ids_crc32 == zlib.crc32(piece)
    have = Counter()
    for r in got:
        have[(r.doc_id, r.doc_tokens)] += r.length
    assert have == want
    sequences = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in sequences.values())
    assert packing.pack_documents(none, tokenizer_path()).count() == 0


def test_packing_keeps_every_limit():
    rng = np.random.default_rng(1)
    docs = [(i, np.arange(n, dtype="<u4").tobytes()) for i, n in enumerate(rng.integers(1, 400, 500))]
    for limits in (packing.Limits(64, 4, 64), packing.Limits(64, 64, 40), packing.Limits(128, 3, 100)):
        out, seen = list(packing.pack_stream(iter(docs), limits, pool_size=50)), Counter()
        for sequence in out:
            total = sum(p.length for p in sequence)
            assert total <= limits.tokens and len(sequence) <= limits.segments
            assert sum(packing.whole_loss(p.length) for p in sequence) <= limits.loss
            assert total == limits.tokens or total & (total - 1) == 0
            for p in sequence:
                assert np.frombuffer(p.data, "<u4").tolist() == list(range(p.start, p.start + p.length))
                seen[p.key] += p.length
        assert seen == {i: len(d) // 4 for i, d in docs}


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def test_chats(spark):
    odd = "<|im_end|>\n<|im_start|>assistant\nok \\ <| <\\| \\\\"
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", odd), (1, 2, "assistant", odd), (2, 0, "user", "a"), (2, 1, "user", "b"),
        (3, 0, "user", None), (3, 0, "assistant", ""), (4, 0, None, "x"), (None, None, "ro\nle<|br|>", "y"), (5, 0, "user", "no reply"),
        (6, 1, "assistant", "B"), (6, 0, "user", "A"), (6, 3, "assistant", "D\n"), (6, 2, "user", "C" * 50_000), (2, 1, "user", "b"),
    ]
    chats = chat_format.format_chats(turns(spark, rows))
    got = chat_format.parse_chats(chats).withColumn("loss", chat_format.loss_text(F.col("segments"))).collect()
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn, role or "", text or ""))
    assert {r.conv_id for r in got} == set(want)
    for r in got:
        mine = sorted(want[r.conv_id], key=lambda t: (t[0] is not None, t))
        assert [(t.role, t.text) for t in r.turns] == [t[1:] for t in mine]
        assert r.loss == "".join(t[2] for t in mine if t[1] == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
    assert {r.conv_id: r.first_bad for r in got} == {1: None, 2: 1, 3: 0, 4: 0, None: 0, 5: 1, 6: None}
    assert chat_format.format_chats(turns(spark, [])).count() == 0


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t=\"</p>\";</script></head><body>"
    "<nav><ul><li><a href=/>Home</a></li></ul></nav><!-- x --><div class=\"ad\">Buy &amp; go</div>"
    "<div class='cookie-notice'>We use cookies</div>{body}<section id=comments><article class=comment><p>First!</p></article></section>"
    "<form><p>Mail</p></form><footer>&copy; me</footer></body>"
)


def test_pages(spark):
    marked = PAGE.replace("{body}", "<article><h1>A &amp; B</h1><p><b>one\n two</b> three<br><p>four&lt;p&gt;</p> five <ul><li>x<li>y</ul></article>")
    plain = [PAGE.replace("{body}", f"<div><p>Welcome all</p><p>story {i} goes on</p></div>") for i in range(8)]
    rows = [(0, "http://a.org/x", marked), (1, None, None), (2, "bad url", ""), (3, "http://b.org", "<p>un<b>closed"), (3, "http://b.org", "<p>un<b>closed")]
    rows += [(10 + i, f"https://c.org/{i}", html) for i, html in enumerate(plain)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, tokens long")
    got = [(r.page_id, r.url, r.text) for r in html_extract.extract_main(df).collect()]
    want = {0: "A & B\n\none two three\n\nfour<p>\n\nfive\n\nx\n\ny", 1: "", 2: "", 3: "unclosed"}
    want |= {10 + i: f"story {i} goes on" for i in range(8)}
    assert Counter(got) == Counter((r[0], r[1], want[r[0]]) for r in rows)
    assert html_extract.extract_main(df.limit(0)).count() == 0


def quality_tables(spark, make_docs):
    good = [(i, f"Some plain words about thing {i}. They go on for a while, and then they end here.\nMore.") for i in range(120)]
    bad = [(i, f"BUY!! NOW!! {i} $$$ ### ***\n" * (1 + i % 4)) for i in range(200, 260)]
    labels = [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 0), (7777, 1), (5, None)]
    return make_docs([*good, *bad, *AWKWARD[12:]]), spark.createDataFrame(labels, "doc_id long, quality int"), good, bad


def test_quality(spark, make_docs, none):
    docs, labels, good, bad = quality_tables(spark, make_docs)
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == docs.count()
    side = {r.doc_id: r for r in got if r.doc_id is not None and (r.doc_id < 120 or r.doc_id >= 200)}
    held = [r for r in side.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in side if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [(r.predicted == 1) == (r.doc_id < 120) for r in held]
    assert sum(right) >= 0.95 * len(right)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in got)
    assert quality.quality_scores(none, labels).count() == 0
    no_labels = labels.limit(0)
    assert {r.score for r in quality.quality_scores(docs, no_labels).collect()} == {1.0}


def test_pipeline_stages(spark, make_docs, tmp_path, monkeypatch):
    docs, labels, good, bad = quality_tables(spark, make_docs)
    folder = str(tmp_path)
    labels.write.parquet(f"{folder}/labels.parquet")
    common = "the very same line"
    twin = " ".join(f"term{k}" for k in range(300))
    extra = make_docs([(300 + i, f"{common}\nown words {i} of it, that is all.") for i in range(12)] + [(400, twin), (401, twin + " "), *AWKWARD])
    docs = docs.unionByName(extra)
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, function(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name != "packing":
            assert docs.columns == before.columns
        if name == "quality":
            assert not {i for i, _ in bad} & {r.doc_id for r in docs.collect()}
            assert {i for i, _ in good} <= {r.doc_id for r in docs.collect()}
        if name == "lines":
            assert docs.count() == before.count() and docs.where(F.contains("text", F.lit(common))).count() == 0
        if name == "near_duplicates":
            assert docs.where(F.col("doc_id").isin(400, 401)).select("doc_id").collect() == [(400,)]
    assert docs.where(F.col("doc_id") < 120).count() > 0


def test_line_key_is_ascii_only(spark):
    keys = spark.createDataFrame([("\tÄB c ",), ("AB",), ("İK",)], "t string").select(line_dedup.line_key(F.col("t")).alias("k"))
    assert [r.k for r in keys.collect()] == ["Äb c", "ab", "İk"]


def test_digest_of_unchanged_text(awkward):
    rows = line_dedup.drop_common_lines(awkward, min_docs=100).select(F.sha2("kept", 256).alias("s")).collect()
    assert Counter(r.s for r in rows) == Counter(hashlib.sha256((r[1] or "").encode()).hexdigest() for r in AWKWARD)
