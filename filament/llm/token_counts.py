"""Operator 3, token counts: count-only Viterbi over a unigram vocabulary.

The vocabulary is the piece list of a tokenizer file, piece -> score.  An Aho-Corasick
automaton enumerates the pieces that end at each position; dynamic programming keeps, per
position, the best score and the number of pieces on that path - no back pointers, no
pieces, no ids.  Ties are broken as unigram tokenizers break them: pieces that end at a
position are tried from the earliest start, and a later one replaces the kept one only if
its score is strictly greater.  A character that no piece of one character covers may be
taken as unknown at (lowest score - 10); runs of unknowns count as one piece, or as one
piece per UTF-8 byte with ``byte_fallback``.

A space becomes the mark U+2581 and one mark is put in front.  No piece of such a
vocabulary holds a mark after another character, so the best path of a text is the
concatenation of the best paths of its words (scores are integers, sums are exact); counts
are therefore computed once per distinct word and added up.  A vocabulary with pieces that
cross words is run over whole texts instead.

Defined results: null and empty texts count 0 pieces; repeated rows count each by itself;
columns other than the id and the text are not read.  Whole texts are counted.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame

from .common import arrow_map, per_worker

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: words whose counts a worker remembers
CACHE_WORDS = 400_000


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, without control, unknown and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def has_byte_pieces(path: str) -> bool:
    """Does the model file hold byte pieces, so that it writes unknown characters as bytes?"""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return any(sp.is_byte(i) for i in range(sp.get_piece_size()))


class Counter:
    """Counts the pieces of texts under one vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = False):
        self.machine = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.machine.add_word(piece, (len(piece), score))
        self.machine.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.by_words = not any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in vocabulary)
        self.byte_fallback = byte_fallback
        self.cache: dict[str, int] = {}
        self.singles = frozenset(p for p, _ in vocabulary if len(p) == 1)

    def covered(self, text: str) -> int:
        """``viterbi`` where each character is a piece, so that no unknown can win."""
        best, count, at = [0.0], [0], -1
        for end, (length, score) in self.machine.iter(text):  # by end, longest first
            s = best[end + 1 - length] + score
            if end != at:
                best.append(s)
                count.append(count[end + 1 - length] + 1)
                at = end
            elif s > best[-1]:
                best[-1] = s
                count[-1] = count[end + 1 - length] + 1
        return count[-1]

    def viterbi(self, text: str) -> int:
        """Pieces on the best path over ``text`` (marks already in place)."""
        if self.singles.issuperset(text):
            return self.covered(text)
        n = len(text)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        tail = [False] * (n + 1)  # the path to here ends with an unknown
        at, matches = 0, []
        ends = self.machine.iter(text)
        nxt = next(ends, None)
        while at < n:
            matches.clear()
            while nxt is not None and nxt[0] == at:
                matches.append(nxt[1])
                nxt = next(ends, None)
            end, top = at + 1, None
            for length, score in matches:  # longest first: from the earliest start on
                s = best[end - length] + score
                if top is None or s > top:
                    top, pick = s, length
            if not matches or matches[-1][0] != 1:
                s = best[at] + self.unknown
                if top is None or s > top:
                    top, pick = s, 0
            best[end] = top
            if pick:
                count[end] = count[end - pick] + 1
            elif self.byte_fallback:
                count[end] = count[at] + len(text[at].encode("utf-8", "surrogatepass"))
            else:
                count[end], tail[end] = count[at] + (not tail[at]), True
            at = end
        return count[n]

    def words(self, text: str) -> list[str]:
        """``text`` cut before each run of marks that follows another character."""
        marked = MARK + text.replace(" ", MARK)
        return re.split(f"(?<=[^{MARK}])(?={MARK})", marked) if self.by_words else [marked]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.by_words:
            return self.viterbi(self.words(text)[0])
        total, cache = 0, self.cache
        simple = "  " not in text and text[0] != " " and MARK not in text
        for w in text.split(" ") if simple else self.words(text):
            n = cache.get(w)
            if n is None:
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                n = cache[w] = self.viterbi(MARK + w if simple else w)
            total += n
        return total


def count_tokens(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                 byte_fallback: bool = False) -> DataFrame:
    """One row per input row: the id and ``n_tokens``.  The vocabulary file is read on the
    driver and broadcast (its size does not depend on the data)."""
    vocabulary = df.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary_path))
    schema = f"{id_col} {df.schema[id_col].dataType.simpleString()}, n_tokens long"

    def run(batches):
        counter = per_worker(("token_counts", vocabulary_path, byte_fallback), lambda: Counter(vocabulary.value, byte_fallback))
        for b in batches:
            yield {id_col: b.column(0), "n_tokens": [counter.count(t) for t in b.column(1).to_pylist()]}

    return arrow_map(df.select(id_col, text_col), run, schema)
