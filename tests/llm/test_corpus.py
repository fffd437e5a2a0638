"""Operators over the whole corpus against brute force: n-gram scores, token shards, decontamination, mixing, near duplicates, pipeline."""

import collections
import zlib

import numpy as np
import pytest
from fixtures import DOCS, awkward_rows, frame, words

from tamis.llm import decontaminate, mixing, near_duplicates, ngram_lm, token_ids
from tamis.llm.common import Members, fold, membership

SF = "/root/testdata/sf0.001"


def texts_of(rows):
    return [(r[0], (r[1] or "").encode()) for r in rows]


# --- near duplicates ---------------------------------------------------------------------


def brute_components(rows):
    sets = []
    for doc, text in rows:
        w = text.lower().split()
        sets.append((doc, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = collections.defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for g in s:
            where[g].append(i)
    for i, (_, s) in enumerate(sets):
        shared = collections.Counter(j for g in s for j in where[g] if j > i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j][1]) - n):
                parent[top(j)] = top(i)
    least = {}
    for i, (doc, s) in enumerate(sets):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return [(doc, len(s), least.get(top(i)) if s else doc) for i, (doc, s) in enumerate(sets)]


def as_sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def edited(rng, text, share):
    w = text.split(" ")
    for k in rng.choice(len(w), max(1, int(share * len(w))), replace=False):
        w[k] = f"x{rng.integers(1 << 30)}"
    return " ".join(w)


def test_near_duplicates_are_those_of_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = awkward_rows()
    base = " ".join(f"b{k}" for k in range(200))
    step = base
    for k in range(30):  # a chain: each near its neighbour, the ends far apart
        rows.append((1000 + k, step, "en", "s", 1))
        step = edited(rng, step, 0.012)
    for k in range(60):  # copies at all distances from one text, around the threshold too
        rows.append((2000 + k, edited(rng, base, 0.005 + 0.001 * (k % 40)), "en", "s", 1))
    got = near_duplicates.clustered(frame(spark, rows, extra=True)).collect()
    assert as_sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got]) == as_sorted(brute_components(texts_of(rows)))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates.clustered(frame(spark, [])).count() == 0
    only_empty = near_duplicates.clustered(frame(spark, [(1, None, None, None, None), (2, "", None, None, None)])).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in only_empty) == [(1, 1, True), (2, 2, True)]


def test_one_document_of_each_group_stays(spark):
    rows = [(3, "a b c d e f g", "en", "s", 1), (1, "A b c d e f g", "en", "s", 1), (2, "other words stand in this text", "en", "s", 1)]
    out = near_duplicates.one_of_each(frame(spark, rows, extra=True))
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 2] and out.columns == frame(spark, rows, extra=True).columns


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    texts = [" ".join(f"{g}{k}" for k in range(9)) for g in "pqrst"]
    rows = [(3, texts[0]), (1, texts[0]), (3, "other words stand in this text")]  # one id with two texts
    rows += [(4, texts[1]), (4, texts[1])]  # equal rows
    rows += [(None, texts[2]), (5, texts[2])]  # a null id
    rows += [(None, texts[3]), (None, texts[3].upper())]
    rows += [(6, ""), (6, ""), (7, None)]  # linked with nothing
    got = near_duplicates.one_of_each(frame(spark, [(doc, text, "en", "s", 1) for doc, text in rows], extra=True)).collect()
    got = sorted(((r["doc_id"], (r["text"] or "").lower()) for r in got), key=str)
    assert got == sorted([(1, texts[0]), (3, "other words stand in this text"), (4, texts[1]), (5, texts[2]), (None, texts[3]), (6, ""), (6, ""), (7, "")], key=str)


def test_unlike_texts_that_share_keys_in_blocks(spark, monkeypatch):
    # Pairs at about 0.7 share keys without being linked; a few are edited copies of others. Small blocks deal the keys out.
    monkeypatch.setattr(near_duplicates, "BLOCK", 16)
    rng = np.random.default_rng(8)
    base = [f"b{k}" for k in range(300)]
    rows = []
    for k in range(120):
        own = base[: 40 * (k % 3 == 0)] + base[40:] if k % 2 else base[20:]
        text = " ".join(own + [f"own{k}x{x}" for x in range(int(rng.integers(40, 70)))])
        rows.append((k, text, "en", "s", 1))
        if k % 10 == 0:
            rows.append((1000 - k, edited(rng, text, 0.02), "en", "s", 1))
    got = near_duplicates.clustered(frame(spark, rows)).collect()
    expected = brute_components(texts_of(rows))
    assert len({c for _, _, c in expected}) > 20
    assert as_sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got]) == as_sorted(expected)


def test_inverted_index_finds_the_pairs_of_brute_force():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 60, 40).astype(np.uint64)
    sets = [np.sort(rng.permutation(pool)[: int(rng.integers(1, 41))]) for _ in range(60)]
    near = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
    for first in (0, 25):
        expected = {(x, y) for x in range(60) for y in range(x + 1, 60) if near(sets[x], sets[y]) and (not first or x < first <= y)}
        assert expected and {(x, int(y)) for x, ys in near_duplicates.linked(sets, first) for y in ys} == expected


def test_signatures_within_the_distance_share_a_key():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, near_duplicates.INDEXED)
        b = a.copy()
        wrong = rng.choice(len(a), 2 * near_duplicates.CHUNKS - 1, replace=False)
        b[wrong] += 1
        chunks = (a != b).reshape(near_duplicates.CHUNKS, near_duplicates.WIDTH).sum(1)
        assert chunks.min() <= 1


# --- decontamination ---------------------------------------------------------------------


def test_contaminated_documents_are_those_of_full_alignment(spark):
    rng = np.random.default_rng(4)
    items = [(k, " ".join(f"i{rng.integers(300)}" for _ in range(12 + 6 * k))) for k in range(6)] + [(90, None), (91, ""), (92, "two words")]
    noise = lambda n: " ".join(f"n{rng.integers(300)}" for _ in range(n))
    rows = awkward_rows()
    for k in range(40):
        text = items[k % 6][1]
        kind = k // 10
        text = text if kind == 0 else edited(rng, text, 0.1) if kind == 1 else text.upper().replace(" ", ", ") if kind == 2 else " ".join(text.split(" ")[:4])
        rows.append((3000 + k, noise(80) + " " + text + " " + noise(80), "en", "s", 1))
    rows.append((3999, "here are two words", "en", "s", 1))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame(spark, rows, extra=True), benchmark).collect()}
    folded = decontaminate.Folded()
    brute = {
        (doc, item) for doc, text in texts_of(rows) for item, t in items
        if t and decontaminate.align(folded.of(t.encode()), folded.of(text)) >= decontaminate.LEAST
    }
    assert got == brute
    assert {d for d, _ in got} >= set(range(3000, 3030)) | {3999} and not {d for d, _ in got} & set(range(3030, 3040))
    out = decontaminate.without_contaminated(frame(spark, rows), benchmark)
    assert out.columns == frame(spark, rows).columns and out.count() == len(rows) - len({d for d, _ in got})
    assert decontaminate.contaminated(frame(spark, []), benchmark).count() == 0
    assert decontaminate.contaminated(frame(spark), benchmark.limit(0)).count() == 0
    blocks = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame(spark, rows), benchmark, block=40).collect()}
    assert blocks == got


def test_contaminated_folds_each_document_once_a_block(spark):
    import os

    from tamis.scratch import scratch_folder

    rng = np.random.default_rng(8)
    items = [(k, " ".join(f"i{rng.integers(300)}" for _ in range(20))) for k in range(4)]
    rows = awkward_rows() + [(3000 + k, f"before it {items[k % 4][1]} and behind it", "en", "s", 1) for k in range(8)]
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    docs = frame(spark, rows).mapInArrow(seen, DOCS)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == {(3000 + k, k % 4) for k in range(8)}
    assert read.value == len(rows)  # not again for the alignment
    several = len(list(decontaminate.blocks(benchmark, 20)))
    more = decontaminate.contaminated(docs, benchmark, block=20)
    assert {(r["doc_id"], r["item_id"]) for r in more.collect()} == got
    assert several > 1 and read.value <= (1 + several) * len(rows)
    assert not [x for x in os.listdir(scratch_folder(spark).removeprefix("file:")) if x.startswith("holding")]  # gone with its block


def test_alignment():
    a = lambda s: np.array([ord(c) for c in s], dtype=np.uint64)
    assert decontaminate.align(a("abcdef"), a("xxabcdefyy")) == 1.0
    assert decontaminate.align(a("abcdef"), a("xxabcXdefyy")) == 1.0  # one put in
    assert decontaminate.align(a("abcdef"), a("xxabdefyy")) == pytest.approx(5 / 6)  # one left out
    assert decontaminate.align(a("abcdef"), a("zzzz")) == 0.0 == decontaminate.align(a(""), a("z"))


# --- token shards ------------------------------------------------------------------------


@pytest.mark.parametrize("shard_ids", [token_ids.SHARD_IDS, 60])
def test_token_shards_round_trip(spark, tmp_path, shard_ids):
    from tokenizers import Tokenizer

    rows = awkward_rows() + [(60, "<|endoftext|> É Straße ﬁ 日本語 a\x1cb don't WE'LL 12", "en", "s", 1)]
    path = str(tmp_path / "shards")
    token_ids.write(frame(spark, rows, extra=True), path, shard_ids=shard_ids)
    got = token_ids.read(spark, path).orderBy("start").collect()
    t = Tokenizer.from_file(token_ids.default_tokenizer())
    ids = {(r[0], r[1] or ""): [*t.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows}
    crc = lambda x: zlib.crc32(np.array(x, dtype="<u4").tobytes())
    expected = collections.Counter((r[0], len(ids[r[0], r[1] or ""]), crc(ids[r[0], r[1] or ""])) for r in rows)
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == expected
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    order = [r["doc_id"] for r in got]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    assert (spark.read.parquet(path).count() > 3) == (shard_ids == 60) or shard_ids != 60


@pytest.mark.parametrize("shard_ids", [token_ids.SHARD_IDS, 60])
def test_documents_are_found_by_key(spark, tmp_path, shard_ids):
    from tokenizers import Tokenizer

    rows = awkward_rows() + [(7, f"text number {k} of one id", "en", "s", 1) for k in range(30)]
    path = str(tmp_path / "shards")
    token_ids.write(frame(spark, rows), path, shard_ids=shard_ids)
    t = Tokenizer.from_file(token_ids.default_tokenizer())
    keys = [7, 53, 50, None, 4, 999_999, -5]
    got = collections.Counter((r["doc_id"], tuple(r["ids"])) for r in token_ids.get(spark, path, keys).collect())
    assert got == collections.Counter((r[0], (*t.encode(r[1] or "", add_special_tokens=False).ids, 1)) for r in rows if r[0] in keys)
    assert token_ids.get(spark, path, []).count() == 0


def test_pieces_are_those_of_the_tokenizer():
    encoder = token_ids.Encoder(token_ids.default_tokenizer())
    assert encoder.simple
    rng = np.random.default_rng(7)
    letters = list("abcXYZ019 \t\n.,'!-_<|>#@éÉßñöÀÿ×÷") + ["'s", "'LL", "n't", "<|", "|>", "日", "ﬁ", "\x1c", "\u00a0"]
    for _ in range(4000):
        text = "".join(rng.choice(letters, int(rng.integers(0, 40))))
        assert encoder.encode(text.encode()) == encoder._packed(encoder.tokenizer.encode(text, add_special_tokens=False).ids), text


@pytest.mark.parametrize("group_bytes", [token_ids.GROUP_BYTES, 200])
def test_texts_split_together_have_the_ids_of_each(monkeypatch, group_bytes):
    monkeypatch.setattr(token_ids, "GROUP_BYTES", group_bytes)
    encoder = token_ids.Encoder(token_ids.default_tokenizer())
    rng = np.random.default_rng(8)
    simple = list("abcXYZ019 \t\n.,'!-_<|>#@éÉßñöÀÿ") + ["'s", "'LL", "n't", "'street", "!'s", "'re", " '"]
    others = ["<|", "|>", "日", "ﬁ", "\x1c", "\u00a0", "×", "÷", "\x00", "e\u0301"]
    texts = ["", "'", "s", "'", "re", " ", "a'l", "l"]
    for k in range(6000):
        letters = simple + others * (k % 5 == 0)
        texts.append("".join(rng.choice(letters, int(rng.integers(0, 30)))))
    texts.append("it's " * 3_000)
    want = [encoder._packed(t.ids) for t in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert list(encoder.encode_all([t.encode() for t in texts])) == want
    assert list(encoder.encode_all([])) == [] and list(encoder.encode_all([b"", b" "])) == [b"", b""]


def test_a_group_asks_for_each_distinct_piece_once(monkeypatch):
    encoder = token_ids.Encoder(token_ids.default_tokenizer())
    asked = []
    monkeypatch.setattr(encoder, "pieces", type("Asked", (dict,), {"__missing__": lambda self, piece: asked.append(piece) or encoder._piece(piece)})())
    ids = list(encoder.encode_all([b"the cat, the CAT", b"a cat's cat"] * 50))
    assert sorted(asked) == [b"'s", b",", b"a", b"cat", b"the"] and len(ids) == 100


def test_few_shards_stand_in_a_row_group(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(token_ids, "ROW_GROUP_BYTES", 4_096)
    path = tmp_path / "shards"
    token_ids.write(frame(spark, [(k, f"{k} words of a text " * 200, "en", "s", 1) for k in range(40)]).coalesce(1), str(path), shard_ids=500)
    files = [pq.ParquetFile(f).metadata for f in path.glob("*.parquet")]
    assert sum(f.num_rows for f in files) == 40 and sum(f.num_row_groups for f in files) >= 20


def test_a_task_that_ends_gives_free_memory_back():
    import os
    import subprocess
    import sys

    # In a process of its own: blocks that are freed below one still in use stay with the C library until it is told.
    code = """
import re
from pathlib import Path
from tamis.llm.common import released
held = lambda: int(re.search(r"RssAnon:\\s+(\\d+)", Path("/proc/self/status").read_text())[1]) / 1024
blocks = [bytes([k % 7 + 1]) * 2_000 for k in range(60_000)]
blocks = blocks[-1:]
before = held()
list(released([]))
print(before - held())
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    run = subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=60)
    assert run.returncode == 0 and float(run.stdout) > 60, run


def test_a_worker_keeps_one_thing_between_tasks_and_drops_it_for_others():
    from tamis.llm import common

    made = []
    make = lambda: made.append(1) or [1]
    try:
        for _ in range(3):
            list(common.released([1, 2], keeps=True))
            common.kept("one", make)
        assert len(made) == 1
        common.kept("two", make)
        assert list(common._kept) == ["two"]
        assert list(common.released([1, 2])) == [1, 2] and not common._kept
    finally:
        common._kept.clear()


def test_no_documents_no_shards(spark):
    assert token_ids.encoded(frame(spark, [])).count() == 0


def test_minimal_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 7, 125, 3000):
        keys, ordinals = rng.integers(-(1 << 62), 1 << 62, n), np.zeros(n, dtype=np.uint32)
        _, _, slots = token_ids.perfect_hash(keys, ordinals)
        assert sorted(slots.tolist()) == list(range(n))
        shard = token_ids.Shard(token_ids.pack(keys.tolist(), ordinals.tolist(), [np.array([k], dtype="<u4").tobytes() for k in range(n)]))
        assert [int(shard.get(int(k))[0]) for k in keys[:50]] == list(range(min(n, 50)))
        assert sum(shard.get(int(k)) is not None for k in rng.integers(-(1 << 62), 1 << 62, 200)) == 0
    with pytest.raises(ValueError):
        token_ids.perfect_hash(np.array([5, 5]), np.zeros(2, dtype=np.uint32))


# --- n-gram scores -----------------------------------------------------------------------


def test_scores_against_exact_counts(spark):
    rows = awkward_rows()
    docs = frame(spark, rows, extra=True).withColumn("held_out", fold("doc_id", 5) == 1)
    got = ngram_lm.score(docs).collect()
    held = lambda doc: zlib.crc32(("" if doc is None else str(doc)).encode()) % 5 == 1
    seqs = [(doc, held(doc), [*text.lower().split(), 0]) for doc, text in texts_of(rows)]
    c = collections.Counter(w for _, h, s in seqs if not h for w in s)
    pairs = collections.Counter(p for _, h, s in seqs if not h for p in zip([1, *s], s, strict=False))
    n, v = sum(c.values()), len(c)
    expected = []
    for doc, h, s in seqs:
        p = [(c[w] + 0.5) / (n + 0.5 * (v + 1)) for w in s]
        lm = 0.0
        for x, w, pw in zip([1, *s], s, p, strict=False):
            cv = c[0] if x == 1 else c[x]
            cvw = pairs[x, w] if pairs[x, w] >= ngram_lm.LEAST_PAIR else 0
            lm += np.log10((min(cvw, cv) + ngram_lm.MU * pw) / (cv + ngram_lm.MU))
        expected.append((doc, h, len(s), sum(c[w] > 0 for w in s), n, float(np.log10(p).sum()), lm))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(expected, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6)
        assert a[6] == pytest.approx(b[6], rel=0.03)  # quantised counts


def test_scores_without_training_rows(spark):
    docs = frame(spark, [(1, "a b", "en", "s", 1)]).selectExpr("*", "true as held_out")
    r = ngram_lm.score(docs).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, pytest.approx(0.0))
    assert ngram_lm.score(frame(spark, []).selectExpr("*", "true as held_out")).count() == 0


def rare_pair_scores(spark, uncut):
    """(doc_id, score, brute force) of texts of rare words; pairs that come less than ``uncut`` times count 0."""
    rng = np.random.default_rng(6)
    rows = [(k, " ".join(f"r{int(x)}" for x in rng.zipf(1.3, 60) % 4000), "en", "s", 1) for k in range(120)]
    docs = frame(spark, rows).selectExpr("*", "false as held_out")
    seqs = {doc: [*text.split(), 0] for doc, text in texts_of(rows)}
    c = collections.Counter(w for s in seqs.values() for w in s)
    pairs = collections.Counter(p for s in seqs.values() for p in zip([1, *s], s, strict=False))
    n, v = sum(c.values()), len(c)
    assert sum(x == 1 for x in pairs.values()) > 1000
    for r in ngram_lm.score(docs).collect():
        s, lm = seqs[r["doc_id"]], 0.0
        for x, w in zip([1, *s], s, strict=False):
            cv = c[0] if x == 1 else c[x]
            cvw = pairs[x, w] if pairs[x, w] >= uncut else 0
            lm += np.log10((cvw + ngram_lm.MU * (c[w] + 0.5) / (n + 0.5 * (v + 1))) / (cv + ngram_lm.MU))
        yield r["doc_id"], r["score"], lm


def test_no_level_is_left_out_however_many_insertions(spark, monkeypatch):
    # A filter of fixed size would hold 2**27 / BITS_EACH = 2048 insertions here; there are more.
    monkeypatch.setattr(ngram_lm, "BITS_EACH", 1 << 16)
    for doc, score, brute in rare_pair_scores(spark, ngram_lm.LEAST_PAIR):
        assert score == pytest.approx(brute, rel=0.01), doc


def test_pairs_that_come_once_count(spark):
    for doc, score, brute in rare_pair_scores(spark, 1):
        assert score == pytest.approx(brute, rel=0.01), doc


def test_rare_words_are_looked_up_by_their_owners(spark, monkeypatch):
    monkeypatch.setattr(ngram_lm, "FREQUENT", 4)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", (fold("doc_id", 5) == 1).alias("held_out"))
    rare = {r["doc_id"]: r for r in ngram_lm.score(docs).collect()}
    monkeypatch.setattr(ngram_lm, "FREQUENT", 1 << 19)
    for r in ngram_lm.score(docs).collect():
        assert r["n_known"] == rare[r["doc_id"]]["n_known"] and r["base_score"] == pytest.approx(rare[r["doc_id"]]["base_score"], abs=1e-6)


# --- mixing ------------------------------------------------------------------------------


def brute_targets(sizes):
    """Shares by weight, capped at twice the source, the excess shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > 2 * sizes[s]}
        if not over:
            target |= {s: unit * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_targets_and_totals(spark):
    rng = np.random.default_rng(0)
    rows = [(k, " ".join(["w"] * int(rng.integers(0, 60))), "en", ["a", "b", "c", "Z", None, "é"][int(rng.choice(6, p=[0.4, 0.2, 0.1, 0.1, 0.1, 0.1]))], k) for k in range(1500)]
    rows += [(5000, None, None, "a", None), (None, "x y", None, "b", None), (7, rows[7][1], "en", rows[7][3], 7)]
    out = mixing.mix(frame(spark, rows, extra=True)).collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    target = brute_targets(sizes)
    taken = collections.Counter()
    for r in out:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    assert len(out) == len(rows)
    assert all(abs(taken[s] - target[s]) <= 60 for s in sizes)
    again = mixing.mix(frame(spark, rows).repartition(3)).collect()
    pick = lambda x: sorted((str(r["doc_id"]), r["size"], r["copies"]) for r in x)
    assert pick(again) == pick(out)


def test_unequal_importance_and_repetition(spark):
    from pyspark.sql import functions as F

    rows = [(k, "w w w w", "en", "s", k) for k in range(900)] + [(k, "w w w w", "en", "t", k) for k in range(900, 1000)]
    rare = mixing.mix(frame(spark, rows), weights=(1, 1), share=0.5, importance=F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)).where("source = 's'")
    even, odd = (rare.where(f"doc_id % 2 = {k}").agg(F.sum("copies")).first()[0] for k in (0, 1))
    assert 2 < even / odd < 4.5
    out = mixing.repeated(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(frame(spark, rows)).collect()}
    assert collections.Counter(r["doc_id"] for r in out.collect()) == collections.Counter({k: n for k, n in copies.items() if n})
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, [(1, None, None, None, None)])).first()["taken"] == 0


# --- pipeline and helpers ----------------------------------------------------------------


def test_bit_tables(spark):
    rng = np.random.default_rng(0)
    h = rng.integers(-(1 << 63), (1 << 63) - 1, 1000)
    table = Members(membership(spark.createDataFrame([(int(x),) for x in h], "h long"), "h", 20))
    assert table.has(h.view(np.uint64)).all()
    assert table.has(rng.integers(0, 1 << 63, 10_000).astype(np.uint64)).mean() < 0.01


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = docs
    steps = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, SF)
        steps[name] = kept.collect()
        assert kept.columns == docs.columns
        kept = spark.createDataFrame(steps[name], docs.schema)
    near = brute_components([(r["doc_id"], r["text"].encode()) for r in steps["toxicity"]])
    assert sorted(r["doc_id"] for r in steps["near_duplicates"]) == sorted(doc for doc, _, component in near if doc == component)
    folded = decontaminate.Folded()
    items = [folded.of(r["text"].encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r["doc_id"] for r in steps["near_duplicates"] if max(decontaminate.align(i, folded.of(r["text"].encode())) for i in items) < decontaminate.LEAST]
    assert sorted(r["doc_id"] for r in steps["decontamination"]) == sorted(clean)
    mixed = collections.Counter(r["doc_id"] for r in steps["mixing"])
    assert set(mixed) <= set(clean) and max(mixed.values()) <= 2
    out = corpus_pipeline.run(spark, SF).collect()
    assert collections.Counter(r["doc_id"] for r in out) == mixed
    assert set(mixed) <= set(rows)


@pytest.mark.parametrize("stage", range(4))
def test_stages_take_awkward_rows(spark, stage):
    import corpus_pipeline

    name, run = corpus_pipeline.STAGES[stage]
    rows, docs = awkward_rows(), frame(spark, extra=True)
    out = run(spark, docs, SF)
    assert out.columns == docs.columns, name
    got = collections.Counter(tuple(r)[:5] for r in out.collect())
    assert set(got) <= set(rows), name
    if name == "toxicity":  # labels of other documents: rows go or stay by their text
        assert {r[1] for r in got}.isdisjoint({r[1] for r in rows if r not in got})
    if name == "near_duplicates":
        sets = brute_components(texts_of(rows))
        assert sum(got.values()) == len({c for _, n, c in sets if n}) + sum(n == 0 for _, n, _ in sets)
    if name == "decontamination":
        assert got == collections.Counter(rows)
    if name == "mixing":
        assert all(n <= 2 * rows.count(r) for r, n in got.items())
    empty = run(spark, frame(spark, [], extra=True), SF)
    assert empty.columns == docs.columns and empty.count() == 0, name


def test_pipeline_of_awkward_and_of_no_rows(spark, tmp_path):
    import shutil

    import corpus_pipeline

    for name, rows in (("some", awkward_rows()), ("none", [])):
        folder = tmp_path / name
        folder.mkdir()
        for t in ("labels", "benchmark"):
            shutil.copy(f"{SF}/{t}.parquet", folder)
        frame(spark, rows, extra=True).coalesce(1).write.parquet(str(folder / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(folder)).orderBy("start").collect()
        assert (len(out) > 0) == (name == "some")
        assert [r["start"] for r in out] == [sum(x["n_tokens"] for x in out[:k]) for k in range(len(out))]


def test_words_helper():
    import random

    assert len(words(random.Random(0), 5).split()) == 5 and DOCS.count(",") == 4
