"""Fuzzy search for short license notices: exact seeds, then matching with bounded errors.

1. A text becomes its words (the word class of the decontamination contract,
   A-Z lower-cased), joined by single spaces; line breaks, punctuation and
   comment marks between words vanish.
2. Each notice may differ from the text by ``errors`` edits of one character. It
   is split into ``errors + 1`` pieces: by the pigeonhole principle one of them
   stands in any match unchanged. All pieces of all notices are located in one
   pass of an Aho-Corasick automaton.
3. A piece at a place says where its notice could begin and end, give or take
   the errors. That window, cut at word borders, is verified by the regex
   library's fuzzy matching (best match, at most ``errors`` edits).
4. Of overlapping matches of one label the one with the fewest edits stays. A
   match is reported with its span in words and in characters of the text.

Beside the fuzzy notices, exact phrases are counted word by word (``PHRASES``).

Work is a scan of each text and a window of bounded length per seed; verified
windows are remembered (``MEMO`` per task), so a line that a third of all
documents share is verified once. Nothing is shuffled.

Defined results: a null or empty text, or one without words, has no place, no
label and score 0; repeated rows are rows of their own; a null ``doc_id`` stays
null; texts of any length are read whole; an empty table gives an empty result.
Only ``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: fixed values: the phrases that count as base places, and their labels
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Notice:
    """Words joined by spaces, the label they stand for and the edits that are allowed."""

    words: str
    label: str
    errors: int


NOTICES = (
    Notice("under the mit license", "mit", 2),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 7),
    Notice("under the apache license version 2 0", "apache", 3),
    Notice("gnu general public license", "gpl", 2),
    Notice("gnu lesser general public license", "lgpl", 3),
    Notice("gnu affero general public license", "agpl", 3),
    Notice("mozilla public license", "mpl", 2),
    Notice("redistribution and use in source and binary forms", "bsd", 5),
    Notice("licensed under cc by 4 0", "cc-by", 1),
    Notice("licensed under cc by sa 4 0", "cc-by-sa", 1),
    Notice("licensed under cc by nc 4 0", "cc-by-nc", 1),
    Notice("creative commons attribution", "cc-by", 2),
    Notice("creative commons attribution sharealike", "cc-by-sa", 3),
    Notice("creative commons attribution noncommercial", "cc-by-nc", 3),
    Notice("dedicated to the public domain", "public-domain", 3),
    Notice("all rights reserved", "all-rights-reserved", 2),
)

#: verified windows remembered by one task
MEMO = 20_000
#: bytes that stand in words stay (A-Z lower-cased), all others become a space
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pieces(words: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` consecutive pieces of a notice with their offsets, as equal as can be."""
    n = errors + 1
    cuts = [len(words) * i // n for i in range(n + 1)]
    return [(a, words[a:b]) for a, b in zip(cuts, cuts[1:])]


def plain_words(text: str) -> tuple[str, int]:
    """The words of a text joined by single spaces, and their number."""
    found = text.encode("utf-8", "replace").translate(_TABLE).split()
    return b" ".join(found).decode("utf-8", "replace"), len(found)


def phrase_places(plain: str, phrases: dict[str, str]) -> list[tuple[int, str]]:
    """``(first character, phrase)`` of every place where a phrase's words stand consecutively."""
    found = []
    for phrase in phrases:
        at = plain.find(phrase)
        while at >= 0:
            end = at + len(phrase)
            if (at == 0 or plain[at - 1] == " ") and (end == len(plain) or plain[end] == " "):
                found.append((at, phrase))
            at = plain.find(phrase, at + 1)
    return sorted(found)


class NoticeMatcher:
    """Finds notices in plain words: seeds by automaton, windows by fuzzy matching."""

    def __init__(self, notices: tuple[Notice, ...], memo: int = MEMO):
        import ahocorasick
        import regex
        self.notices, self.most, self.memo = notices, memo, {}
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n.words, literal_spaces=True)}){{e<={n.errors}}}") for n in notices]
        seeds: dict[str, list] = {}
        for i, n in enumerate(notices):
            for offset, piece in pieces(n.words, n.errors):
                seeds.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, wanted in seeds.items():
            self.automaton.add_word(piece, (len(piece), wanted))
        self.automaton.make_automaton()

    def windows(self, plain: str) -> set[tuple[int, int, int]]:
        """``(notice, first, end)`` of the places at which a seed allows a match, cut at word borders."""
        found = set()
        for last, (size, wanted) in self.automaton.iter(plain):
            for i, offset in wanted:
                n = self.notices[i]
                at = last + 1 - size - offset
                low, high = at - n.errors, at + len(n.words) + n.errors
                # the match begins at a word's first and ends at a word's last character
                first = 0 if low <= 0 else plain.find(" ", low - 1, at + n.errors) + 1
                if low > 0 and not first:
                    continue
                end = len(plain) if high >= len(plain) else plain.rfind(" ", first, high + 1)
                if end > first:
                    found.add((i, first, end))
        return found

    def best(self, i: int, window: str) -> tuple[int, int, int] | None:
        """``(first, end, edits)`` of the best match of notice ``i`` between word borders of a window."""
        key = (i, window)
        if key in self.memo:
            return self.memo[key]
        if len(self.memo) >= self.most:
            self.memo.clear()
        found = None
        starts = [0, *[p + 1 for p, c in enumerate(window) if c == " "]]
        ends = [*[p for p, c in enumerate(window) if c == " "], len(window)]
        n = self.notices[i]
        for a in starts:
            for b in ends:
                if abs(b - a - len(n.words)) <= n.errors and b > a:
                    m = self.patterns[i].fullmatch(window[a:b])
                    if m and (found is None or sum(m.fuzzy_counts) < found[2]):
                        found = (a, b, sum(m.fuzzy_counts))
        self.memo[key] = found
        return found

    def matches(self, plain: str) -> list[tuple[str, int, int, int, float]]:
        """``(label, first, end, edits, similarity)``; of overlapping matches of a label the one with the fewest edits."""
        found = set()
        for i, first, end in self.windows(plain):
            m = self.best(i, plain[first:end])
            if m:
                n = self.notices[i]
                found.add((n.label, first + m[0], first + m[1], m[2], 1.0 - m[2] / len(n.words)))
        kept: list[tuple[str, int, int, int, float]] = []
        taken: dict[str, list[tuple[int, int]]] = {}
        for m in sorted(found, key=lambda x: (x[3], x[1], -x[2], x[0])):
            spans = taken.setdefault(m[0], [])
            if all(m[2] <= a or m[1] >= b for a, b in spans):
                spans.append((m[1], m[2]))
                kept.append(m)
        return sorted(kept, key=lambda x: (x[1], x[2], x[0]))


def word_offsets(text: str) -> list[tuple[int, int]]:
    """First and end character of every word of a text."""
    import re
    return [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))]


FIELDS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "spans array<struct<label:string,first_word:bigint,n_words:bigint,start:bigint,end:bigint,edits:bigint>>")


def _searcher(notices: tuple[Notice, ...], phrases: dict[str, str]) -> Callable:
    def make():
        matcher = NoticeMatcher(notices)

        def one(text: str) -> tuple:
            plain, n_words = plain_words(text)
            places = phrase_places(plain, phrases)
            base = sorted({phrases[p] for _, p in places})
            starts = [plain.count(" ", 0, at) for at, _ in places]
            found = matcher.matches(plain)
            spans = []
            if found:
                offsets = word_offsets(text)
                for label, first, end, edits, _ in found:
                    w, n = plain.count(" ", 0, first), plain.count(" ", first, end) + 1
                    spans.append({"label": label, "first_word": w, "n_words": n, "start": offsets[w][0], "end": offsets[w + n - 1][1], "edits": edits})
            labels = sorted({*base, *[m[0] for m in found]})
            score = 1.0 if places else max((m[4] for m in found), default=0.0)
            return (n_words, len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(labels), score, spans)

        return lambda texts: zip(*[one(t) for t in texts])

    return make


def license_notices(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES, phrases: dict[str, str] | None = None) -> DataFrame:
    """``doc_id`` and ``FIELDS`` of every document.

    ``spans`` are the fuzzy matches: label, first word and number of words,
    first and end character in the text, and edits. ``n_base``, ``first_word``,
    ``last_word`` and ``base_labels`` tell of the exact phrases; ``labels`` has
    both. ``score`` is 1 where a phrase stands, else the best match's
    similarity (1 - edits / length), else 0.
    """
    return map_texts(docs, _searcher(notices, dict(phrases or PHRASES)), FIELDS, keep_rows=False)


def license_query(docs: DataFrame) -> DataFrame:
    """The digest columns of ``license_notices`` and the number of fuzzy matches."""
    d = license_notices(docs)
    return d.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", F.size("spans").cast("long").alias("n_fuzzy"))
