"""Quality rules, line first: lines that fail a rule go, then documents that lose too much of their text.

Line rules, in order: ``blank`` (no word; not counted as a loss), ``symbols``
(over ``SYMBOL_SHARE`` of its words carry one of #*$%&|<>, and it has more than two words), ``navigation`` (a
menu: at least ``MENU_ITEMS`` items cut by bars; or a line of at most ``SHORT_LINE`` words that is nothing but a navigation
phrase), ``boilerplate`` (a line of at most ``NOTICE_LINE`` words with a consent, login, script or rights phrase),
``punctuation`` (a line of at least ``SENTENCE_LINE`` words whose last word doesn't end in an end mark, closing quotes and
brackets aside). The phrases are given in English, German, French and Spanish. A document is rejected if the
lost words exceed ``MOST_LOST`` of its words, or if it is below the base limits.

Null or empty text: all counts 0, base_failed true, kept false. An empty table: no rows. Each row is judged on its own, so ties,
repeated rows, null ids and very long texts need nothing special; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tamis.llm.common import small_batches, table

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
LEAST_WORDS = 50
SYMBOL_SHARE = 0.5
MENU_ITEMS = 4
SHORT_LINE = 8
NOTICE_LINE = 25
SENTENCE_LINE = 8
MOST_LOST = 0.5

# Phrases in en, de, fr, es; case is ignored, blanks match any blanks. A navigation phrase is a whole line.
NAVIGATION_PHRASES = (
    "home", "home page", "menu", "main menu", "search", "next", "previous", "back", "back to top", "skip to content", "skip to main content", "read more", "load more",
    "show more", "share this", "share on facebook", "share on twitter", "site map", "sitemap", "contact us", "about us", "print this page", "related articles", "view all",
    "startseite", "hauptmenü", "suche", "weiter", "zurück", "nach oben", "zum inhalt springen", "mehr lesen", "weiterlesen", "mehr anzeigen", "teilen", "kontakt", "über uns", "impressum",
    "accueil", "menu principal", "recherche", "suivant", "précédent", "retour", "haut de page", "aller au contenu", "lire la suite", "voir plus", "partager", "plan du site", "contactez-nous", "à propos",
    "inicio", "menú", "menú principal", "buscar", "siguiente", "anterior", "volver", "volver arriba", "ir al contenido", "leer más", "ver más", "compartir", "mapa del sitio", "contacto", "sobre nosotros",
)
BOILERPLATE_PHRASES = (
    "cookie", "cookies", "javascript", "log in", "login", "sign in", "sign up", "subscribe", "newsletter", "privacy policy", "terms of use", "terms of service", "click here", "lorem ipsum", "all rights reserved",
    "anmelden", "registrieren", "abonnieren", "datenschutz", "datenschutzerklärung", "nutzungsbedingungen", "hier klicken", "alle rechte vorbehalten",
    "connexion", "se connecter", "s'inscrire", "s'abonner", "politique de confidentialité", "conditions d'utilisation", "cliquez ici", "tous droits réservés", "mentions légales",
    "iniciar sesión", "registrarse", "suscribirse", "suscríbete", "política de privacidad", "condiciones de uso", "términos de uso", "haga clic aquí", "todos los derechos reservados", "aviso legal",
)
END_MARKS = (".", "!", "?", ":", ";", "\u2026", "\u3002", "\uff01", "\uff1f")
CLOSERS = "\"')]}\u2019\u201d\u00bb"


def _any(phrases: tuple[str, ...]) -> str:
    return "|".join(re.escape(p).replace("\\ ", r"\s+") for p in sorted(phrases, key=len, reverse=True))


NAVIGATION = re.compile(rf"(?i)^\W*(?:{_any(NAVIGATION_PHRASES)})\W*$")
BOILERPLATE = re.compile(rf"(?i)(?<!\w)(?:{_any(BOILERPLATE_PHRASES)})(?!\w)")
MARKED = re.compile(rb"[#*$%&|<>]")


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a window of three words found at least twice in the text."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    m = len(number)
    pairs = ids[:-1] * m + ids[1:]
    if m > 2_000_000:  # three ids no longer fit 64 bits: number the pairs first
        _, pairs = np.unique(pairs, return_inverse=True)
    windows = pairs[:n] * m + ids[2:]
    order = np.argsort(windows, kind="stable")
    s = windows[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n + 2, dtype=bool)
    for k in range(3):
        covered[k : n + k] |= twice
    return int(covered.sum())


def line_verdict(line: bytes) -> str:
    """The first rule that the line fails, or 'ok'."""
    words = line.split()
    n = len(words)
    if not n:
        return "blank"
    marked = sum(MARKED.search(w) is not None for w in words) if MARKED.search(line) else 0
    if marked > SYMBOL_SHARE * n and n > 2:
        return "symbols"
    if line.count(b" | ") >= MENU_ITEMS - 1:
        return "navigation"
    if n <= NOTICE_LINE:
        t = line.decode()
        if n <= SHORT_LINE and NAVIGATION.search(t):
            return "navigation"
        if BOILERPLATE.search(t):
            return "boilerplate"
    if n >= SENTENCE_LINE and not words[-1].decode().rstrip(CLOSERS).endswith(END_MARKS):
        return "punctuation"
    return "ok"


def judged(text: bytes) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost_words, clean text)"""
    words = text.split()
    n = len(words)
    chars = sum(map(len, words))
    if not text.isascii():  # count code points: no continuation bytes
        chars -= int(np.count_nonzero((np.frombuffer(text, dtype=np.uint8) & 0xC0) == 0x80))
    symbols = sum(text.count(bytes((c,))) for c in SYMBOLS)
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    dup = 0
    for line in lines:
        if line.strip(WHITE):
            dup += line in seen
            seen.add(line)
    rep = repeat_words(words)
    base_failed = n < LEAST_WORDS or 100 * rep > 50 * n
    lost, kept_lines = 0, []
    for line in lines:
        if line_verdict(line) in ("ok", "blank"):
            kept_lines.append(line)
        else:
            lost += len(line.split())
    kept = not base_failed and lost <= MOST_LOST * n
    return n, chars, symbols, dup, rep, base_failed, kept, lost, b"\n".join(kept_lines)


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, lost_words long"


def clean(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """docs: doc_id, text. One row a document with the counts and the verdict; clean_text is what the line rules leave."""
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            rows = [judged(x or b"") for x in b.column(1).cast(pa.large_binary()).to_pylist()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 9
            arrays = [pa.array(c, type=pa.bool_() if k in (5, 6) else pa.int64()) for k, c in enumerate(cols[:8])]
            out = [b.column(0), *arrays]
            if with_text:
                out.append(pa.array(cols[8], type=pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = SCHEMA + (", clean_text string" if with_text else "")
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost_words."""
    return clean(table(spark, sf_dir, "documents"), with_text=False)
