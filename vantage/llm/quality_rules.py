"""Line-first quality rules.

Every line of a document is judged on its own (punctuation, repetition,
navigation and boilerplate rules). Failing lines are removed, and a document
that loses too large a share of its words that way is rejected, as is one that
fails the base limits (too few words, too many repeated three-word windows).

One pass over the scan, no shuffle: a document is judged from its own text.

Defined results: a null or empty text has no words and fails the base limits;
a line without words never fails and is kept; repeated rows and repeated or
null ids are judged row by row; an empty table gives an empty result. Extra
columns are left out of the verdict table and passed through by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vantage.llm.shared import slices

SYMBOLS = b"#*$%&|<>"

# Phrases that mark page furniture, by language (fixed values, lower case).
BOILERPLATE_BY_LANGUAGE = {
    "en": (
        "accept cookies", "all rights reserved", "cookie policy", "enable javascript", "lorem ipsum", "privacy policy",
        "skip to content", "terms of service", "terms of use", "uses cookies",
    ),
    "de": (
        "cookies akzeptieren", "alle rechte vorbehalten", "cookie-richtlinie", "javascript aktivieren", "datenschutzerklärung",
        "zum inhalt springen", "allgemeine geschäftsbedingungen", "nutzungsbedingungen", "verwendet cookies",
    ),
    "fr": (
        "accepter les cookies", "tous droits réservés", "politique de cookies", "activer javascript", "politique de confidentialité",
        "aller au contenu", "conditions générales", "conditions d'utilisation", "utilise des cookies",
    ),
    "es": (
        "aceptar cookies", "aceptar las cookies", "todos los derechos reservados", "política de cookies", "activar javascript",
        "política de privacidad", "saltar al contenido", "términos del servicio", "términos y condiciones", "utiliza cookies",
    ),
}
BOILERPLATE = tuple(p.encode() for own in BOILERPLATE_BY_LANGUAGE.values() for p in own)
# Words of navigation bars, by language (fixed values, lower case). A line
# without closing punctuation that consists of them is one.
NAVIGATION_BY_LANGUAGE = {
    "en": ("home", "contact", "about", "login", "register", "search", "menu", "imprint", "sitemap", "help"),
    "de": ("startseite", "kontakt", "impressum", "anmelden", "registrieren", "suche", "menü", "datenschutz", "hilfe"),
    "fr": ("accueil", "contact", "connexion", "inscription", "recherche", "menu", "mentions", "légales", "aide"),
    "es": ("inicio", "contacto", "acceder", "registrarse", "buscar", "menú", "aviso", "legal", "ayuda"),
}
NAVIGATION = frozenset(w.encode() for own in NAVIGATION_BY_LANGUAGE.values() for w in own)
TERMINAL = (".", "!", "?", ":", ";", '"', "'", ")", "»", "”", "’", "…", "。", "！", "？")


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the document verdict.

    A line of n words fails when it has more than ``symbols_per_word`` n
    symbol characters, more than ``shouts_per_word`` n exclamation marks (from
    ``min_shout_words`` words), more than ``repeats_per_word`` n words equal
    to the word before (from ``min_repeat_words`` words), when it has at most
    ``nav_words`` words and no closing punctuation, or when it has at most
    ``boilerplate_words`` words and holds a boilerplate phrase. A document is
    rejected when more than ``max_lost_percent`` of its words go.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    symbols_per_word: float = 0.3
    shouts_per_word: float = 0.5
    min_shout_words: int = 5
    repeats_per_word: float = 0.25
    min_repeat_words: int = 6
    nav_words: int = 3
    boilerplate_words: int = 25
    max_lost_percent: int = 30


VERDICT_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, n_lines long, "
    "n_removed_lines long, n_removed_words long"
)


def line_fails(line: bytes, words: list[bytes], rules: LineRules) -> bool:
    """Whether one line (with its words) breaks a line rule."""
    n = len(words)
    if n == 0:
        return False
    if len(line) - len(line.translate(None, SYMBOLS)) > rules.symbols_per_word * n:
        return True
    if n >= rules.min_shout_words and line.count(b"!") > rules.shouts_per_word * n:
        return True
    if n >= rules.min_repeat_words:
        same = sum(map(bytes.__eq__, words, words[1:]))
        if same > rules.repeats_per_word * n:
            return True
    if n <= rules.boilerplate_words:
        low = line if line.isascii() else line.decode("utf-8", "surrogatepass").lower().encode("utf-8", "surrogatepass")
        low = low.lower()
        navigation = n <= rules.nav_words or NAVIGATION.issuperset(low.split())
        if navigation and not words[-1].decode("utf-8", "surrogatepass").endswith(TERMINAL):
            return True
        return any(p in low for p in BOILERPLATE)
    return False


def repeated_window_words(words: list[bytes]) -> int:
    """Words covered by a three-word window that the text holds twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    x = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n + 2)
    k = len(ids)
    pair = x[:-1] * k + x[1:]
    if k < 2_000_000:  # the triple of ids still fits 63 bits
        triple = pair[:-1] * k + x[2:]
    else:
        _, rank = np.unique(pair, return_inverse=True)
        triple = rank[:-1].astype(np.int64) * k + x[2:]
    order = np.argsort(triple)
    same = triple[order[1:]] == triple[order[:-1]]
    if not same.any():
        return 0
    covered = np.zeros(n + 2, bool)
    hit = np.concatenate([order[1:][same], order[:-1][same]])
    for shift in range(3):
        covered[hit + shift] = True
    return int(covered.sum())


def judge(text: str | None, rules: LineRules) -> tuple[tuple, list[bytes]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_lines, n_removed_lines, n_removed_words) and the
    lines that stay."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words: list[bytes] = []
    seen: set[bytes] = set()
    stay: list[bytes] = []
    dup = lines = gone = gone_words = 0
    for line in raw.split(b"\n"):
        own = line.split()
        if own:
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
            words += own
            if line_fails(line, own, rules):
                gone += 1
                gone_words += len(own)
                continue
        stay.append(line)
    n = len(words)
    chars = len(b"".join(words).decode("utf-8", "surrogatepass"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    repeated = repeated_window_words(words)
    base = n < rules.min_words or 100 * repeated > rules.max_repeat_percent * n
    kept = not base and 100 * gone_words <= rules.max_lost_percent * n
    return (n, chars, symbols, dup, repeated, base, kept, lines, gone, gone_words), stay


def verdicts(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """One row per document row: base counts, line counts and the verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 3
        for whole in batches:
            for b in slices(whole, 1):
                rows = [judge(t, rules)[0] for t in _texts(b.column(1))]
                cols = list(zip(*rows)) or [()] * 10
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(cols, types))],
                    names=[f.split(" ")[0] for f in VERDICT_SCHEMA.split(", ")],
                )

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, VERDICT_SCHEMA)


def clean(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, all columns, their failing lines removed
    (``n_chars``, where present, follows the new text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.schema.get_field_index("text")
            for b in slices(whole, at):
                texts, rows = [], []
                for i, t in enumerate(_texts(b.column(at))):
                    verdict, stay = judge(t, rules)
                    if verdict[6]:
                        rows.append(i)
                        texts.append(b"\n".join(stay).decode("utf-8", "surrogatepass") if verdict[8] else t)
                out = b.take(pa.array(rows, pa.int64()))
                out = out.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))
                if (k := b.schema.get_field_index("n_chars")) >= 0:
                    out = out.set_column(k, b.schema.field(k), pa.array([len(t) for t in texts], b.schema.field(k).type))
                yield out

    return docs.mapInArrow(run, docs.schema)


def _texts(column: pa.Array) -> Iterator[str | None]:
    for x in column:
        yield x.as_py()
