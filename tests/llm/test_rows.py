"""Operators that judge each document alone: personal data, line rules, language, licenses, toxicity."""

import collections
import hashlib
import re
import zlib

import pyarrow as pa
import pytest
from fixtures import DOCS, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from tamis.llm import language_id, licenses, line_rules, pii, toxicity


def naive_spans(text):
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = [c for c in m.group() if "0" <= c <= "9"]
            ok = {
                "email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 13 <= len(digits) <= 19 and pii.luhn("".join(digits)), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab@.-_%+ 0123456789()é\n", max_size=80))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == naive_spans(text)


def test_known_data_is_found():
    text = "mail a.b@x.example.com, call +1 (234) 555-6789 from 10.0.0.255 with 4539 1488 0343 6467 token = \"0123456789abcdef0123456789abcdef01234567\" é"
    (base, every), = pii.all_spans([text], pii.default_crf())
    assert [k for k, _, _ in base] == ["email", "ip", "card", "phone"]
    assert set(base) <= set(every)
    assert [text[a:b] for k, a, b in every if k == "secret"] == ["0123456789abcdef0123456789abcdef01234567"]


def test_stretches_decode_as_whole_texts():
    crf = pii.default_crf()
    assert crf.safe()
    rows = pii.labelled_table(60, seed=99)
    texts = [" ".join(w) for w, _ in rows]
    whole = pii.Crf(crf.emissions, crf.moves)
    whole.safe = lambda: False
    assert [sorted(x) for x in pii.crf_spans(texts, crf)] == [sorted(x) for x in pii.crf_spans(texts, whole)]
    gold = sum(x != "O" for _, labels in rows for x in labels)
    labels = [pii.LABELS[k] for w, _ in rows for k in crf.decode(pii.features(w)[None], pii.np.array([len(w)]))[0]]
    right = sum(a == b != "O" for a, b in zip(labels, (x for _, y in rows for x in y), strict=True))
    assert right > 0.9 * gold


def test_stretches_decode_as_whole_documents(spark):
    crf = pii.default_crf()
    whole = pii.Crf(crf.emissions, crf.moves)
    whole.safe = lambda: False
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r["text"]]
    texts += ["password : correct-horse-battery-staple-and-more", "contact us: jean.dupont-at-example.com", "don't | well-known a.b", "x" * 5000 + "-" + "9" * 5000]
    got = [sorted(x) for x in pii.crf_spans(texts, crf)]
    assert got == [sorted(x) for x in pii.crf_spans(texts, whole)] and all(got[-4:-2])


def test_crf_from_a_table_of_the_users(spark):
    rows = pii.labelled_table()
    crf = pii.crf_from(spark.createDataFrame(rows, "words array<string>, labels array<string>"))
    (_, every), = pii.all_spans(["write to an.re12@timo.example.com today"], crf)
    assert [k for k, _, _ in every] == ["email"]


def test_pii_frame(spark):
    data = ["mail a.b@x.example.com and c@d.org, 10.0.0.255 é 4539 1488 0343 6467 +1 (234) 555-6789", "no data at all", "1.2.3.4.5.6.7.8 a@b.c"]
    rows = [(k, text, "en", "s", 1) for k, text in enumerate(data)]
    for r in pii.find(frame(spark, rows, extra=True)).collect():
        spans = naive_spans(data[r["doc_id"]])
        assert [r[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == kind for k, _, _ in spans) for kind in pii.KINDS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r["spans"].split(","))
    out = pii.find(frame(spark, extra=True))
    rows = out.collect()
    assert len(rows) == frame(spark).count()
    empty = [r for r in rows if r["doc_id"] in (50, 51, 52)]
    assert all(r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in empty)
    assert pii.find(frame(spark, [])).count() == 0


def naive_lines(text):
    white = "[^ \t\n\x0b\x0c\r]+"
    w = re.findall(white, text)
    n = len(w)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(white, line):
            dup += line in seen
            seen.add(line)
    grams = {}
    for i in range(n - 2):
        grams.setdefault(tuple(w[i : i + 3]), []).append(i)
    rep = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(rep), n < 50 or 100 * len(rep) > 50 * n


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é|#\n\t\x0b ", max_size=200))
def test_line_counts(text):
    assert line_rules.judged(text.encode())[:6] == naive_lines(text)


def test_line_rules(spark):
    clean = "This is a plain sentence of a clean text, as they come.\n" + " ".join(f"word{k}" for k in range(60)) + "."
    menu = "\n".join(f"a{k} | b{k} | c{k} | d{k} | e{k}" for k in range(20))
    rows = [(1, clean, "en", "s", 1), (2, menu, "en", "s", 1), (3, None, None, None, None), (None, clean, "en", "s", 1)]
    got = {r["doc_id"]: r for r in line_rules.clean(frame(spark, rows, extra=True)).collect()}
    assert got[1]["kept"] and got[None]["kept"] and got[1]["clean_text"] == clean
    assert not got[2]["kept"] and got[2]["clean_text"] == ""
    assert not got[3]["kept"] and got[3]["base_failed"] and got[3]["n_words"] == 0
    assert line_rules.clean(frame(spark, [])).count() == 0
    assert line_rules.clean(frame(spark)).count() == frame(spark).count()


def plain_lost(text):
    """Words of failing lines, rule by rule, without the operator's patterns."""
    white, lost = "[^ \t\n\x0b\x0c\r]+", 0
    for line in text.split("\n"):
        w = re.findall(white, line)
        tight = re.sub(r"\s+", " ", line).strip().lower()
        edge = lambda c: not (c.isalnum() or c == "_")
        bare = tight
        while bare and edge(bare[0]):
            bare = bare[1:]
        while bare and edge(bare[-1]):
            bare = bare[:-1]
        holds = any(tight[k : k + len(p)] == p and (not k or edge(tight[k - 1])) and (k + len(p) == len(tight) or edge(tight[k + len(p)])) for p in line_rules.BOILERPLATE_PHRASES for k in range(len(tight)))
        end = w[-1] if w else "."
        while end and end[-1] in line_rules.CLOSERS:
            end = end[:-1]
        fails = (
            (len(w) > 2 and sum(any(c in "#*$%&|<>" for c in x) for x in w) > 0.5 * len(w)) or line.count(" | ") >= 3 or (len(w) <= 8 and bare in line_rules.NAVIGATION_PHRASES)
            or (len(w) <= 25 and holds) or (len(w) >= 8 and (not end or end[-1] not in line_rules.END_MARKS))
        )
        lost += len(w) * fails
    return lost


def test_every_phrase_fires():
    for p in line_rules.NAVIGATION_PHRASES:
        assert line_rules.line_verdict(f"» {p.capitalize()}".encode()) == "navigation"
    for p in line_rules.BOILERPLATE_PHRASES:
        assert line_rules.line_verdict(f"Some words, {p.upper()} and others.".encode()) in ("boilerplate", "navigation"), p
    assert line_rules.line_verdict(b"one two three four five six seven eight") == "punctuation"
    assert line_rules.line_verdict("one two three four five six seven (eight.”)".encode()) == "ok"


def test_verdicts_against_a_plain_version(spark):
    lines = ["Home", "Accueil »", "We use cookies.", "Alle Rechte vorbehalten", "a b c d e f g h", "A sentence of eight words stands right here.", "## ** $$", "a | b | c | d", "x y", "", " \t"]
    body = " ".join(f"word{k}" for k in range(45)) + "."
    rows = [(k, "\n".join([lines[(k * 7 + j * j) % len(lines)] for j in range(k % 23)] + [body] * (k % 3 > 0)), "en", "s", 1) for k in range(120)]
    rows += [(r["doc_id"] + 1000, r["text"], "en", "s", 1) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    verdicts = set()
    for r in line_rules.clean(frame(spark, rows)).collect():
        text = dict((k, t) for k, t, *_ in rows)[r["doc_id"]] or ""
        n, *_, failed = naive_lines(text)
        lost = plain_lost(text)
        assert (r["lost_words"], r["kept"]) == (lost, not failed and lost <= 0.5 * n), text
        verdicts.add((r["kept"], failed))
    assert len(verdicts) == 3


def test_language_id_on_held_out_documents(spark):
    d = language_id.op10_language_id(spark, "/root/testdata/sf0.001")
    truth = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    rows = d.where("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 20 and sum(r["lang"] == r["lang_pred"] for r in rows) > 0.9 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_language_id_frame(spark):
    docs = frame(spark, extra=True)
    langs, vectors = language_id.prototypes(docs)
    assert langs == ["de", "en"]
    out = {r["doc_id"]: r for r in language_id.identify(docs.selectExpr("*", "false as held_out"), langs, vectors).collect()}
    assert all(out[k]["lang_pred"] == "und" and out[k]["score"] == 0 for k in (50, 51, 52))
    nothing = language_id.prototypes(frame(spark, []))
    assert nothing[0] == []
    assert language_id.identify(docs.selectExpr("*", "false as held_out"), *nothing).where("lang_pred <> 'und'").count() == 0
    assert language_id.identify(frame(spark, []).selectExpr("*", "false as held_out"), langs, vectors).count() == 0


def test_languages_against_brute_force(spark):
    import collections

    import numpy as np

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").limit(60).collect()
    rows = [(r["doc_id"], r["text"], r["lang"], "s", 1) for r in docs]
    rows += [(1000 + k, text, lang, "s", 1) for k, (text, lang) in enumerate([("мама мыла раму и раму мыла", "ru"), ("раму мыла мама", None), ("私は学生です", "ja"), ("学生です", None), ("Ça va, été", "fr"), ("123 !?", "de")])]
    table = frame(spark, rows)
    langs, vectors = language_id.prototypes(table)
    base = language_id.letter_vectors()
    codes = language_id.letter_codes()

    def bundle(text):
        letters = [0]
        for c in (text or "").lower() + " ":
            code = int(codes[ord(c)])
            if code or letters[-1]:
                letters.append(code)
        if not any(letters):
            return None, 0
        grams = collections.Counter(zip(letters, letters[1:], letters[2:]))
        total = sum(n * np.roll(base[a], 2).astype(float) * np.roll(base[b], 1) * base[c] for (a, b, c), n in grams.items())
        return total, sum(grams.values())

    sums = {}
    for _, text, lang, *_ in rows:
        v, n = bundle(text)
        if lang is not None and n:
            sums[lang] = sums.get(lang, 0) + v / np.sqrt(n)
    assert langs == sorted(sums)
    for r in language_id.identify(table.selectExpr("*", "false as held_out"), langs, vectors).collect():
        v, n = bundle(dict((k, t) for k, t, *_ in rows)[r["doc_id"]])
        near = {x: float(v @ p / np.linalg.norm(v) / np.linalg.norm(p)) for x, p in sums.items()} if n else {"und": 0.0}
        best = max(near, key=near.get)
        assert r["lang_pred"] == best and r["score"] == pytest.approx(max(0.0, near[best]), abs=1e-4)


def test_bundles_are_sums_of_bound_vectors():
    import numpy as np

    base = language_id.letter_vectors(64)
    grams, counts = language_id.trigrams("Ab, ab")
    bound = sum(c * np.roll(base[g // 128**2], 2) * np.roll(base[g // 128 % 128], 1) * base[g % 128] for g, c in zip(grams, counts, strict=True))
    assert counts.sum() == 5  # " ab", "ab ", "b a", " ab", "ab "
    assert (language_id.Trigrams(64).bundle(grams, counts) == bound).all()


def naive_places(text):
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", fold)
    places = []
    for phrase, label in licenses.BASE:
        p = phrase.split(" ")
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return len(w), places


def test_license_scan(spark):
    texts = [
        None, "", "All rights reserved. all-rights_reserved ALL RIGHTS RESERVED!", "Licensed under CC BY-NC 4.0.", "cc by cc by cc", "under the GNU General Public License, version 3.",
        "Licensed under the Apache License, Version 2.0.", "MIT License", "nothing here, accby", "é cc\nby ü", "x " * 20_000 + "general public license",
    ]
    rows = [(k, t, None, None, None) for k, t in enumerate(texts)]
    out = {r["doc_id"]: r for r in licenses.scan(frame(spark, rows, extra=True)).collect()}
    for k, t in enumerate(texts):
        n, places = naive_places(t)
        assert out[k]["n_words"] == n
        assert sorted((d["start"], d["label"]) for d in out[k]["base"]) == sorted(places), t
    found = lambda k: {d["label"] for d in out[k]["found"]}
    assert "cc-by-nc-4.0" in found(3) and "cc-by-nc" not in found(3)  # the longer one of higher priority suppresses it
    assert "gpl-3.0" in found(5) and "gpl-unspecified" not in found(5)
    assert "apache-2.0" in found(6) and found(7) == {"mit"} and not found(8)
    assert len(licenses.rules()) > 200
    assert licenses.scan(frame(spark, [])).count() == 0


def phrases(pattern):
    """Texts of a rule's pattern: each alternative and optional piece at least once."""
    from itertools import product
    from re import _parser

    def of(items):
        out = [""]
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                ways = [chr(arg)]
            elif name == "IN":
                ways = [chr(a if str(o) == "LITERAL" else a[0]) for o, a in arg]
            elif name == "SUBPATTERN":
                ways = of(arg[3])
            elif name == "BRANCH":
                ways = [w for x in arg[1] for w in of(x)]
            else:
                assert name == "MAX_REPEAT", name
                least, most, inner = arg
                ways = [w * n for w in of(inner) for n in {least, min(int(most), least + 1)}]
            out = [x + w for x, w in product(out, dict.fromkeys(ways))]
        return out

    return list(dict.fromkeys(of(_parser.parse(pattern))))


def test_every_license_rule_fires_on_its_phrase_alone(spark):
    rules = licenses.rules()
    texts = list(dict.fromkeys(t for rule in rules for t in phrases(rule[2])))
    for label, keyword, pattern, _, _ in rules:
        assert all(keyword in f" {t} " and licenses.fixed_part(pattern) in f" {t} " for t in phrases(pattern)), (label, keyword)
    texts += ["Creative\nCommons Attribution 4.0", "Public  Domain", "CC0", "The WTFPL", "All rights\nreserved", "cc/by", "GENERAL PUBLIC\tLICENSE"]
    out = {r["doc_id"]: r for r in licenses.scan(frame(spark, [(k, t, None, None, None) for k, t in enumerate(texts)])).collect()}
    for k, text in enumerate(texts):
        line = f" {' '.join(re.findall('[a-z0-9]+', text.lower()))} "
        every = set()
        for label, _, pattern, priority, _ in rules:
            for m in re.finditer(f"(?<= )(?:{pattern})(?= )", line):
                start = line[: m.start()].count(" ") - 1
                every.add((start, start + m.group().count(" ") + 1, label, priority))
        rank = lambda d: (d[3], d[1] - d[0])
        kept = {d for d in every if not any(o[0] <= d[0] and o[1] >= d[1] and rank(o) > rank(d) for o in every)}
        assert {(d["start"], d["end"], d["label"], d["priority"]) for d in out[k]["found"]} == kept, text
        assert len(out[k]["found"]) + len(out[k]["base"]) > 0, text
        assert sorted((d["start"], d["label"]) for d in out[k]["base"]) == sorted(naive_places(text)[1]), text


def test_license_query_matches_words(spark):
    d = licenses.op7_license_scan(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in d:
        n, places = naive_places(texts[r["doc_id"]])
        at = [i for i, _ in places]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (n, len(at), min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = toxicity.op4_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.6 * len(toxic)
    assert sum(r["predicted"] for r in rows if not r["toxic"]) <= 0.05 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_toxicity_frame(spark):
    docs = frame(spark, extra=True)
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(40)] + [(None, 1), (5, None), (6, 1)], "doc_id long, toxic int")
    model = toxicity.fitted(docs, labels)
    assert toxicity.scored(docs.selectExpr("*", "false as held_out"), model).count() == docs.count()
    none = toxicity.fitted(docs, labels.where("toxic = 0"))
    assert none is None
    assert toxicity.scored(docs.selectExpr("*", "false as held_out"), none).where("predicted = 1").count() == 0
    assert toxicity.without_toxic(docs, labels.limit(0)).columns == docs.columns
    assert toxicity.scored(frame(spark, []).selectExpr("*", "false as held_out"), model).count() == 0


def test_mining_holds_a_bounded_number_of_counts():
    texts = [" ".join(f"{k:x}{j:x}word{(k * 40 + j) % 9973}" for j in range(40)) for k in range(3_000)]
    marks = [k % 7 // 6 for k in range(3_000)]
    batches = [pa.record_batch({"text": pa.array(texts[k : k + 100]), "toxic": pa.array(marks[k : k + 100])}) for k in range(0, 3_000, 100)]
    plain = collections.Counter((f, m) for t, m in zip(texts, marks, strict=True) for f in {f for w in t.split() for f in toxicity.features_of(w.encode())})
    parts, sums = 0, collections.Counter()
    for out in toxicity.feature_counts(iter(batches), 20_000):
        parts += 1
        assert out.num_rows <= 20_000 + 40 * 6
        for f, clean, toxic in zip(*(c.to_pylist() for c in out.columns), strict=True):
            sums.update({k: n for k, n in (((f, 0), clean), ((f, 1), toxic)) if n})
    assert parts > 5 and sums == plain


def test_label_model_discounts_echoes():
    import numpy as np

    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    vote = lambda p: np.where(rng.random(4000) < p, y, ~y) * 2.0 - 1
    poor = vote(0.65)
    v = np.stack([vote(0.9), vote(0.85), *[poor] * 8], axis=1)  # eight echoes of one poor voter
    q = toxicity.posterior(v, np.where(rng.random(4000) < 0.1, ~y, y) * 0.8 + 0.1)
    majority = (v.sum(1) > 0) == y
    assert ((q > 0.5) == y).mean() > max(0.85, majority.mean())


def test_label_model_needs_no_labels_but_for_the_names():
    import numpy as np

    rng = np.random.default_rng(1)
    y = rng.random(6000) < 0.3
    true = (0.9, 0.85, 0.8, 0.75, 0.7, 0.4)  # the last voter is worse than chance
    v = np.stack([np.where(rng.random(6000) < a, y, ~y) * 2.0 - 1 for a in true], axis=1)
    v[rng.random(v.shape) < 0.2] = 0
    q = toxicity.posterior(v, toxicity.vote_prior(v))
    assert ((q > 0.5) == y).mean() > 0.9
    assert np.abs(toxicity.accuracies(v, q) - true).max() < 0.06
    # Brute force: the same mixture, row by row, from the fixed point's own moments.
    w1, w0 = q.sum(), (1 - q).sum()
    m1, m0 = sum(a * x for a, x in zip(q, v, strict=True)) / w1, sum((1 - a) * x for a, x in zip(q, v, strict=True)) / w0
    cov = sum(a * np.outer(x - m1, x - m1) + (1 - a) * np.outer(x - m0, x - m0) for a, x in zip(q, v, strict=True)) / len(v)
    cov = 0.7 * cov + np.eye(6) * (0.3 * np.trace(cov) / 6 + 0.05)
    inverse = np.linalg.inv(cov)
    odds = [np.log(w1 / w0) + (x - m0) @ inverse @ (x - m0) / 2 - (x - m1) @ inverse @ (x - m1) / 2 for x in v[:300]]
    assert np.abs(1 / (1 + np.exp(-np.array(odds))) - q[:300]).max() < 0.02
    assert (toxicity.named(q, (~y).astype(float)) == 1 - q).all()


def test_toxicity_scores_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    weight, bias = {"w:the": 0.3, "4:ther": -0.2, "5:there": 0.7, "w:éa": 1.0}, -0.4
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in toxicity.scored(docs.selectExpr("*", "false as held_out"), (weight, bias)).collect():
        words = re.findall("[^ \t\n\x0b\x0c\r]+", text[r["doc_id"]])
        z = 0.0
        for w in words:
            w = w.strip(toxicity.EDGES.decode()).lower()
            z += sum(weight.get(f, 0.0) for f in {f"w:{w}", *(f"{k}:{w[:k]}" for k in range(4, 9) if len(w) >= k)})
        z = bias + 100 * z / (len(words) + toxicity.SMOOTH)
        assert r["score"] == pytest.approx(1 / (1 + 2.718281828459045**-z)) and r["predicted"] == (z >= 0)


@pytest.mark.parametrize("schema", [DOCS])
def test_schema_is_that_of_documents(spark, schema):
    assert frame(spark).columns == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").columns


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGS", 2)
    rows = [(k, "some words", f"l{k % 3}", "s", 1) for k in range(9)]
    with pytest.raises(ValueError, match="more than 2 languages"):
        language_id.prototypes(frame(spark, rows))
    assert len(language_id.prototypes(frame(spark, rows[:2]))[0]) == 2
