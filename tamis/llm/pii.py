"""Personal data: fixed patterns, and further spans from a linear-chain CRF.

The CRF labels words by features of their shapes (own, previous, next) and of a
cue word before them. It is trained from a small labelled table, by default one made of
templates in ``labelled_table``, by gradient steps on the exact log-likelihood, and decoded
by Viterbi in numpy batches. A word of letters only with such neighbours on either side
carries label O whatever stands around it: ``Crf.safe`` proves from the weights that its margin
exceeds any gain by transitions. Every word's features are looked up; only the stretches around words of other shapes go through
Viterbi, with the same result, and where the proof fails whole texts do.

Base spans stay; CRF spans that overlap none of them are added. Null or empty text: no spans; texts of any length are searched whole; an empty table: no rows.
Every row is answered by itself, so repeated rows, ties and null ids need nothing special;
columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.common import CACHE_ENTRIES, small_batches, table

KINDS = ("email", "ip", "card", "phone")  # in the order of the digest
EXTRA = ("secret",)  # further kinds, only found by the CRF

# Fixed by the contract.
LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_REST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str):
    """Leftmost matches of the email pattern: the rest from its '@', then back over the local part, in linear time."""
    done = 0
    for m in EMAIL_REST.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


def ips(text: str):
    """Dotted chains cut into fours from the left, as leftmost matching cuts them."""
    for m in IP_CHAIN.finditer(text):
        parts, at = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def cards(text: str):
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    out += [("ip", *s) for s in ips(text)]
    out += [("card", *s) for s in cards(text)]
    return out + [("phone", *s) for s in phones(text)] if "+" in text else out


# --- the CRF -----------------------------------------------------------------------------

LABELS = ("O", *(f"{p}-{k}" for k in (*KINDS, *EXTRA) for p in "BI"))
BUCKETS = 512
PLAIN = ("x", "X", "Xx", "xX")  # shapes of words of letters and sentence marks only
CUES = ("none", "secret", "mail", "phone", "card", "ip", "equals")
CUE_OF = {
    **dict.fromkeys(("token", "secret", "password", "passwd", "apikey", "api_key", "key", "bearer"), 1),
    **dict.fromkeys(("mail", "email", "e-mail", "contact"), 2),
    **dict.fromkeys(("phone", "tel", "call", "mobile", "fax"), 3),
    **dict.fromkeys(("card", "visa", "credit"), 4),
    **dict.fromkeys(("ip", "host", "address", "server"), 5),
    **dict.fromkeys(("=", ":", ":=", "=>"), 6),
}
WORD = re.compile(r"[^ \t-\r]+")
SIDE = 3  # words on either side of one that isn't plain that are decoded with it


def shape(word: str) -> str:
    """Letters as X and x, digits as 9, runs of one kind shortened, with a mark of the length of long runs."""
    core = word.strip(".,;:!?\"'()[]{}%&$#*|") or word
    out = []
    for c in core:
        s = "9" if "0" <= c <= "9" else "X" if c.isupper() else "x" if c.isalpha() else c
        if not out or out[-1][0] != s:
            out.append([s, 0])
        out[-1][1] += 1
    hexed = len(core) >= 24 and re.fullmatch(r"[0-9A-Za-z_\-]+", core) and any(c.isdigit() for c in core) and any(c.isalpha() for c in core)
    if hexed:
        return "key"
    if all(s in "xX" for s, _ in out) or not out:
        kinds = "".join(s for s, _ in out)
        return kinds if kinds in PLAIN else "xX" if kinds else "x"
    if core.isdigit() and core.isascii():
        return f"9:{min(len(core), 20)}"
    return "".join(s if n < 4 else s + "+" for s, n in out)


def bucket(name: str) -> int:
    return PLAIN.index(name) if name in PLAIN else len(PLAIN) + int.from_bytes(hashlib.md5(name.encode()).digest()[:4], "little") % (BUCKETS - len(PLAIN) - 1)


EDGE = BUCKETS - 1  # before the first word and after the last


def cue(word: str) -> int:
    return 6 if word in ("=", ":", ":=", "=>") else CUE_OF.get(word.lower().strip("\"'.,;()"), 0)


class Described(dict):
    """word -> (bucket of its shape, cue) as one number, filled on demand and emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = bucket(shape(word)) * len(CUES) + cue(word)
        return value


def features(words: list[str], known: Described | None = None) -> np.ndarray:
    """(words, 4): shape, previous shape, next shape, cue of the two words before."""
    known = Described() if known is None else known
    n = len(words)
    own, cues = np.divmod(np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=n), len(CUES))
    near = np.zeros(n, dtype=np.int32)
    near[1:] = cues[:-1]
    near[2:] = np.where(np.isin(cues[1:-1], (0, 6)) & ~np.isin(cues[:-2], (0, 6)), cues[:-2], cues[1:-1])
    return np.stack([own, np.append(EDGE, own[:-1]), np.append(own[1:], EDGE), near], axis=1).astype(np.int32)


def labelled_table(n: int = 200, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """A small labelled table: sentences of invented words around data made by rule, labelled word by word."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice(("an", "re", "ti", "on", "es", "le", "mo", "da", "ku")) for _ in range(rng.randint(1, 4)))
    hexed = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))

    def data() -> list[tuple[str, str]]:
        kind = rng.choice((*KINDS, "secret", "secret", "number", "year", "code"))
        if kind == "email":
            lead = rng.choice(([], [("contact", "O")], [("email:", "O")]))
            return [*lead, (f"{word()}{rng.choice(('.', '_', ''))}{digits(2)}@{word()}{rng.choice(('', digits(1)))}.{rng.choice(('example.com', 'org', 'net'))}", "B-email")]
        if kind == "ip":
            return [(".".join(str(rng.randint(0, 255)) for _ in range(4)), "B-ip")]
        if kind == "card":
            if rng.random() < 0.5:
                return [(digits(16), "B-card")]
            return [(digits(4), "B-card"), *[(digits(4), "I-card")] * 3]
        if kind == "phone":
            return [(f"+{digits(1)}", "B-phone"), (f"({digits(3)})", "I-phone"), (f"{digits(3)}-{digits(4)}", "I-phone")]
        if kind == "secret":
            cue = rng.choice(("token", "secret", "api_key", "password", "key"))
            value = rng.choice((hexed(40), hexed(32), hexed(64), "sk_" + hexed(28)))
            value = rng.choice((f'"{value}"', f"'{value}'", value))
            return [(cue, "O"), (rng.choice(("=", ":")), "O"), (value, "B-secret")]
        if kind == "year":
            return [(rng.choice(("in", "since")), "O"), (f"{rng.randint(1900, 2030)}.", "O")]
        if kind == "code":
            return [(rng.choice((f"v{digits(1)}.{digits(1)}", f"{digits(1)}.{digits(1)}.", f"CC-{digits(1)}", "x=1", "a/b", "+", "=")), "O")]
        return [(digits(rng.randint(1, 5)), "O")]

    plain = lambda: (rng.choice((word(), word().capitalize(), word() + rng.choice(".,"), word().upper())), "O")
    out = []
    for k in range(n):
        pairs = [plain() for _ in range(rng.randint(1, 5))]
        for _ in range(rng.randint(0, 2) if k % 4 else 0):
            pairs += data() + [plain() for _ in range(rng.randint(1, 4))]
        out.append(([w for w, _ in pairs], [x for _, x in pairs]))
    return out


class Crf:
    """emissions: weights of (feature column, bucket, label); moves: of (label, next label)."""

    def __init__(self, emissions: np.ndarray, moves: np.ndarray):
        self.emissions, self.moves = emissions, moves

    def scores(self, f: np.ndarray) -> np.ndarray:
        return sum(self.emissions[k, f[..., k]] for k in range(4))

    def decode(self, f: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Viterbi over a padded batch: f (sequences, steps, 4). Returns label numbers; those past a sequence's end mean nothing."""
        e = self.scores(f)
        n, steps, _ = e.shape
        best, back = e[:, 0], np.zeros((n, steps, len(LABELS)), dtype=np.int8)
        for t in range(1, steps):
            every = best[:, :, None] + self.moves[None]
            back[:, t] = every.argmax(1)
            live = (t < lengths)[:, None]
            best = np.where(live, every.max(1) + e[:, t], best)
            back[:, t] = np.where(live, back[:, t], np.arange(len(LABELS)))
        out = np.zeros((n, steps), dtype=np.int8)
        out[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            out[:, t - 1] = back[np.arange(n), t, out[:, t]]
        return out

    def safe(self) -> bool:
        """Whether a plain word between plain words (or edges) has label O in any best path."""
        near = [*range(len(PLAIN)), EDGE]
        own, before, after = (x.ravel() for x in np.meshgrid(range(len(PLAIN)), near, near))
        e = self.scores(np.stack([own, before, after, np.zeros_like(own)], axis=1))
        gain = 2 * (self.moves.max() - self.moves.min())
        # A cue word can stand before it, but two cues never lead to other labels on plain words.
        e = np.concatenate([e + self.emissions[3, c] - self.emissions[3, 0] for c in range(len(CUES))])
        return bool((e[:, :1] - e[:, 1:] > gain).all())


def train(rows: list[tuple[list[str], list[str]]], steps: int = 100, rate: float = 0.5, l2: float = 1e-3) -> Crf:
    """Adagrad on the exact log-likelihood of the labelled rows, by forward and backward sums over a padded batch."""
    n, m, k = len(rows), max(len(w) for w, _ in rows), len(LABELS)
    f, y, lengths = np.zeros((n, m, 4), dtype=np.int32), np.zeros((n, m), dtype=np.int64), np.array([len(w) for w, _ in rows])
    for i, (words, labels) in enumerate(rows):
        f[i, : len(words)] = features(words)
        y[i, : len(words)] = [LABELS.index(x) for x in labels]
    live = np.arange(m)[None] < lengths[:, None]
    emissions, moves = np.zeros((4, BUCKETS, k)), np.zeros((k, k))
    emissions[0, : len(PLAIN), 0] = 12.0  # plain words start far on the side of O, and moves stay small, so that safe() holds
    prior = emissions.copy()
    seen = [np.full_like(emissions, 1e-6), np.full_like(moves, 1e-6)]
    gold_moves = np.zeros((k, k))
    np.add.at(gold_moves, (y[:, :-1][live[:, 1:]], y[:, 1:][live[:, 1:]]), 1)
    lse = lambda x, axis: (top := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - top).sum(axis))
    for _ in range(steps):
        e = sum(emissions[c, f[..., c]] for c in range(4))
        a = np.zeros((n, m, k))
        b = np.zeros((n, m, k))
        a[:, 0] = e[:, 0]
        for t in range(1, m):
            a[:, t] = np.where(live[:, t, None], e[:, t] + lse(a[:, t - 1, :, None] + moves, 1), a[:, t - 1])
        for t in range(m - 2, -1, -1):
            b[:, t] = np.where(live[:, t + 1, None], lse(moves + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2), 0)
        z = lse(a[:, -1], 1)
        p = np.exp(a + b - z[:, None, None]) * live[..., None]
        p[np.arange(n)[:, None], np.arange(m)[None], y] -= live
        grad = l2 * (emissions - prior) * n
        for c in range(4):
            np.add.at(grad[c], f[..., c][live], p[live])
        two = np.exp(a[:, :-1, :, None] + moves + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]) * live[:, 1:, None, None]
        grad_moves = two.sum((0, 1)) - gold_moves + 20 * l2 * moves * n
        for w, g, s in ((emissions, grad, seen[0]), (moves, grad_moves, seen[1])):
            s += g * g
            w -= rate * g / np.sqrt(s)
    return Crf(emissions, moves)


@functools.cache
def default_crf() -> Crf:
    return train(labelled_table())


def crf_from(labelled: DataFrame, most: int = 5_000) -> Crf:
    """A CRF trained on a small table of the user's own: words array<string>, labels array<string> (of LABELS).

    At most ``most`` rows are taken, in the order of a hash, so that what reaches the driver is bounded.
    """
    rows = labelled.select("words", "labels").where("size(words) > 0 and size(words) = size(labels)").orderBy(F.xxhash64("words", "labels")).limit(most).collect()
    return train([(list(r["words"]), list(r["labels"])) for r in rows])


def stretches(f: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of words to decode: each word whose shape isn't plain with SIDE words on either side, joined where they meet."""
    at = np.flatnonzero(f[:, 0] >= len(PLAIN))
    if not len(at):
        return []
    low, high = np.maximum(at - SIDE, 0), np.minimum(at + SIDE + 1, len(f))
    new = np.flatnonzero(low[1:] > high[:-1]) + 1
    return list(zip(low[np.append(0, new)].tolist(), high[np.append(new - 1, len(at) - 1)].tolist(), strict=True))


def crf_spans(texts: list[str], crf: Crf, known: Described | None = None) -> list[list[tuple[str, int, int]]]:
    """Spans of the CRF in each text. Stretches of all texts are decoded in batches of like length."""
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    known = Described() if known is None else known
    todo, safe = [], crf.safe()
    for i, text in enumerate(texts):
        spans = [w.span() for w in WORD.finditer(text)]
        if not spans:
            continue
        f = features(WORD.findall(text), known)
        for a, b in stretches(f) if safe else [(0, len(f))]:
            x = f[a:b].copy()
            x[0, 1] = x[-1, 2] = EDGE
            todo.append((i, spans[a:b], x))
    todo.sort(key=lambda x: len(x[1]))
    at = 0
    while at < len(todo):
        size = max(1, min(512, 200_000 // len(todo[at][1])))
        part = todo[at : at + size]
        while len(part) > 1 and len(part[-1][1]) > 2 * len(part[0][1]) + 8:
            part = part[: max(1, len(part) // 2)]
        at += len(part)
        lengths = np.array([len(s) for _, s, _ in part])
        f = np.zeros((len(part), int(lengths.max()), 4), dtype=np.int32)
        for r, (_, _, x) in enumerate(part):
            f[r, : len(x)] = x
        labels = crf.decode(f, lengths)
        for r, (i, spans, _) in enumerate(part):
            kind, start, stop = "", 0, 0
            for (a, b), label in [*zip(spans, labels[r], strict=False), ((0, 0), 0)]:
                name = LABELS[label]
                if name[0] == "I" and name[2:] == kind:
                    stop = b
                    continue
                if kind:
                    found[i].append((kind, start, stop))
                kind, start, stop = (name[2:], a, b) if name != "O" else ("", 0, 0)
    return found


def trimmed(text: str, start: int, stop: int) -> tuple[int, int]:
    while start < stop and text[start] in "\"'([{<,;:":
        start += 1
    while stop > start and text[stop - 1] in "\"')]}>,;:.!?%&$#*|":
        stop -= 1
    return start, stop


def all_spans(texts: list[str], crf: Crf, known: Described | None = None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text; all: by kind as listed, then start."""
    rank = {k: i for i, k in enumerate((*KINDS, *EXTRA))}
    out = []
    for text, more in zip(texts, crf_spans(texts, crf, known), strict=True):
        base = base_spans(text)
        taken = sorted((a, b) for _, a, b in base)
        extra, at = [], 0
        for kind, a, b in sorted(more, key=lambda s: s[1]):
            a, b = trimmed(text, a, b)
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            # Of the base kinds it adds only what holds up: an '@', enough digits, or a sound check digit.
            digits = "".join(c for c in text[a:b] if "0" <= c <= "9")
            sound = {"secret": b - a >= 8, "email": "@" in text[a:b], "ip": len(digits) >= 4, "phone": 9 <= len(digits) <= 15, "card": 13 <= len(digits) <= 19 and luhn(digits)}[kind]
            if a < b and sound and not any(x < b and a < y for x, y in taken[at : at + 4]):
                extra.append((kind, a, b))
        out.append((base, sorted(base + extra, key=lambda s: (rank[s[0]], s[1]))))
    return out


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_extra long"


def find(docs: DataFrame, crf: Crf | None = None) -> DataFrame:
    """docs: doc_id, text. One row a document with counts and spans."""
    small_batches(docs.sparkSession)
    model = crf or default_crf()
    emissions, moves = model.emissions, model.moves  # of fixed size
    joined = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

    def run(batches):
        own, known = Crf(emissions, moves), Described()
        for b in batches:
            rows = []
            for base, every in all_spans([x or "" for x in b.column(1).to_pylist()], own, known):
                n = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), len(every) - len(base)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, type=t) for c, t in zip(cols, kinds, strict=True)]], names=[x.split(" ")[0] for x in SCHEMA.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_extra."""
    return find(table(spark, sf_dir, "documents"))
