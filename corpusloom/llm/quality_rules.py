"""Quality rules by line-first cleaning.

Each line of a text is judged by its own punctuation, navigation and boilerplate
rules; failing lines are removed, and a document that loses too much of its text
that way (or fails the base rules on length and repetition) is rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import WORD, release, small_batches

#: Fixed phrases of boilerplate lines, in four languages.
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "click here to",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "terms of service",
    "terms of use",
    "alle cookies akzeptieren",
    "alle rechte vorbehalten",
    "datenschutzerklärung",
    "newsletter abonnieren",
    "nutzungsbedingungen",
    "abonnez-vous",
    "accepter les cookies",
    "conditions générales",
    "politique de confidentialité",
    "tous droits réservés",
    "aceptar las cookies",
    "política de privacidad",
    "suscríbete a",
    "términos y condiciones",
    "todos los derechos reservados",
)
#: A notice of rights with its year.
COPYRIGHT = r"(?:©|\(c\)|copyright)[ ,:©]*(?:19|20)[0-9]{2}"
#: Words of menus, in four languages.
MENU = (
    "about", "archive", "blog", "contact", "contacts", "faq", "help", "home", "login", "logout", "menu", "news", "next", "previous", "register", "rss", "search", "share", "shop", "sitemap", "subscribe",
    "anmelden", "impressum", "kontakt", "startseite", "suche", "warenkorb", "weiter", "zurück",
    "accueil", "boutique", "connexion", "panier", "recherche", "suivant",
    "buscar", "carrito", "contacto", "inicio", "siguiente", "tienda",
)
#: Signs that part the items of a menu or a breadcrumb; signs of the base counts; marks of which prose has some.
SEPARATORS, SYMBOLS, MARKS = "|•·›→", "#*$%&|<>", ".,;:!?…、。，"
_BOILERPLATE = regex.compile("|".join(map(regex.escape, BOILERPLATE)) + "|" + COPYRIGHT)
_MENU = frozenset(MENU)
_UPPER, _LETTER, _SHOWN, _MARK = regex.compile(r"\p{Lu}"), regex.compile(r"\p{L}"), regex.compile(r"[\p{L}\p{N}]"), regex.compile(f"[{MARKS}]")
_CORE = regex.compile(r"^\P{L}+|\P{L}+$")

FACTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines_removed long, removed_chars long"


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the rules for a line; ratios are in percent of its words.

    Navigation. separators: at least `min_separators` SEPARATORS and at least that many per 100 words. menu: of at most `menu_words` words at
    least `min_menu` and half are MENU words.
    Punctuation. symbols, exclamations: at least `min_signs` and more than that many per 100 words. shout: at least `shout_words` words
    with so many percent of the letters in upper case. bare: so many words without any of MARKS are a list of words. ornament: at least
    `min_signs` characters in words, none of them a letter or a digit.
    Boilerplate. a phrase of BOILERPLATE, or COPYRIGHT, fails a line of at most `boilerplate_words` words.
    max_loss: a document losing more than so many percent of its word characters is rejected.
    """

    min_separators: int = 3
    separators: int = 25
    menu_words: int = 12
    min_menu: int = 3
    min_signs: int = 3
    symbols: int = 50
    exclamations: int = 50
    shout_words: int = 8
    shout: int = 80
    bare: int = 60
    boilerplate_words: int = 20
    max_loss: int = 50

    def is_navigation(self, line: str, words: list[str]) -> bool:
        n, bars = len(words), sum(map(line.count, SEPARATORS))
        if bars >= self.min_separators and 100 * bars >= self.separators * n:
            return True
        if not self.min_menu <= n <= self.menu_words:
            return False
        items = sum(_CORE.sub("", w.lower()) in _MENU for w in words)
        return items >= self.min_menu and 2 * items >= n

    def is_ill_punctuated(self, line: str, words: list[str]) -> bool:
        n, symbols, exclamations = len(words), sum(map(line.count, SYMBOLS)), line.count("!") + line.count("?")
        if symbols >= self.min_signs and 100 * symbols > self.symbols * n:
            return True
        if exclamations >= self.min_signs and 100 * exclamations > self.exclamations * n:
            return True
        if n >= self.shout_words:
            upper = len(_UPPER.findall(line))
            if 4 * upper > n and 100 * upper >= self.shout * len(_LETTER.findall(line)):
                return True
        if n >= self.bare and not _MARK.search(line):
            return True
        return not _SHOWN.search(line) and sum(map(len, words)) >= self.min_signs

    def is_boilerplate(self, line: str, words: list[str]) -> bool:
        return len(words) <= self.boilerplate_words and _BOILERPLATE.search(line.lower()) is not None

    def fails(self, line: str, words: list[str]) -> bool:
        return self.is_navigation(line, words) or self.is_ill_punctuated(line, words) or self.is_boilerplate(line, words)


def repeat_words(words: list[str]) -> int:
    """Words that lie in a 5-word window found twice or more in the text."""
    grams = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(grams)) == len(grams):
        return 0
    counts, covered, end = Counter(grams), 0, 0
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered += i + 5 - max(i, end)
            end = i + 5
    return covered


def judge(text: str | None, rules: LineRules) -> tuple[tuple, str]:
    """The FACTS of one text, and the text without its failing lines."""
    text = text or ""
    words = WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    seen, dups, removed, lost, out = set(), 0, 0, 0, []
    for line in text.split("\n"):
        own = WORD.findall(line)
        if own:
            if line in seen:
                dups += 1
            else:
                seen.add(line)
            if rules.fails(line, own):
                removed += 1
                lost += sum(map(len, own))
                continue
        out.append(line)
    repeated = repeat_words(words)
    failed = n < 10 or 100 * repeated > 20 * n
    kept = not failed and 100 * lost <= rules.max_loss * chars
    return (n, chars, symbols, dups, repeated, failed, kept, removed, lost), "\n".join(out)


def quality_rules(docs: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """docs → id, columns in carry, FACTS, clean_text (the text without its failing lines; null for a null text).

    One row per input row, by a narrow map: no shuffle, memory of one Arrow batch.
    Null and empty texts have zero counts and fail the base rules. Ids may be null or
    repeat; columns besides those named are not read. An empty table gives no rows.
    """
    rows = small_batches(docs).select(id_col, *carry, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            got = [judge(t, rules) for t in texts]
            facts = list(zip(*(f for f, _ in got))) or [()] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], *(pa.array(v, k) for v, k in zip(facts, kinds)), pa.array([None if t is None else c for t, (_, c) in zip(texts, got)], pa.string())],
                names=[*b.schema.names[:-1], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_removed", "removed_chars", "clean_text"],
            )
        release()

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{kept}, {FACTS}, clean_text string")
