"""Token counts under a unigram vocabulary: Viterbi that keeps scores and counts only."""

from __future__ import annotations

from collections.abc import Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

SPACE = "▁"  # stands for a blank in pieces
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 1 << 19  # counts of words kept per Python worker
CACHED_LENGTH = 64
_PIECE = 1 << 20

Vocabulary = Sequence[tuple[str, float]]


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) in the order of a SentencePiece model file.

    Control, unknown and byte pieces are not text: they get the file's lowest
    score, so that a text that spells one is cut into ordinary pieces.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    scores = [model.get_score(i) for i in range(size)]
    low = min(scores)
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
    return [
        (model.id_to_piece(i), low if special[i] else scores[i]) for i in range(size)
    ]


class PieceCounts(dict):
    """Word -> number of pieces of the best cut of the word with a blank before it.

    All vocabulary matches come from one Aho-Corasick pass. Going through the
    word, every position keeps the best score up to it and the pieces of that
    cut. Between equal scores the longer last piece wins, a vocabulary piece
    before an unknown character; a character is unknown where it is no piece by
    itself, scores below the lowest piece and counts one piece per UTF-8 byte.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()

    def count(self, word: str) -> int:
        best, pieces = [0.0], [0]
        end, score, number, alone = 1, float("-inf"), 0, False
        for at, (length, value) in self.automaton.iter(word):  # longest first at each end
            while end <= at:
                if not alone and (new := best[-1] + self.unknown) > score:
                    score, number = new, pieces[-1] + len(word[end - 1].encode())
                best.append(score)
                pieces.append(number)
                end, score, alone = end + 1, float("-inf"), False
            new = best[end - length] + value
            if new > score:
                score, number = new, pieces[end - length] + 1
            if length == 1:
                alone = True
        while end <= len(word):
            if not alone and (new := best[-1] + self.unknown) > score:
                score, number = new, pieces[-1] + len(word[end - 1].encode())
            best.append(score)
            pieces.append(number)
            end, score, alone = end + 1, float("-inf"), False
        return pieces[-1]

    def __missing__(self, word: str) -> int:
        number = self.count(SPACE + word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = number
        return number

    def text(self, text: str | None) -> int:
        """Pieces of a text. Words begin at blanks, so each is cut by itself."""
        if not text:
            return 0
        if SPACE in text:
            text = text.replace(SPACE, " ")
        total, begin = 0, text[0] == " "  # a leading blank belongs to the first word
        while begin <= len(text):
            end = text.find(" ", begin + _PIECE)
            end = len(text) if end < 0 else end
            total += sum(map(self.__getitem__, text[begin:end].split(" ")))
            begin = end + 1
        return total


_counters: dict[int, PieceCounts] = {}


def _counting(vocabulary: Vocabulary):
    name = hash(tuple(vocabulary))

    def apply(texts: pa.Array) -> pa.Array:
        if name not in _counters:
            _counters.clear()
            _counters[name] = PieceCounts(vocabulary)
        count = _counters[name].text
        return pa.array([count(text.as_py()) for text in texts], pa.int64())

    return apply


def token_counts(
    documents: DataFrame, vocabulary: Vocabulary, text: str = "text", name: str = "n_tokens"
) -> DataFrame:
    """``documents`` with the number of pieces of every whole text.

    Scores are added up in double precision; with whole-number scores the sums
    are exact, so cutting words one by one gives what one pass over the text
    gives. Null and empty texts have 0 pieces. A column called ``name`` is
    replaced; all other columns stay. The vocabulary travels with the function;
    each worker builds the automaton once and holds a bounded cache of words.
    """
    count = arrow_udf(_counting(list(vocabulary)), "bigint")
    return documents.withColumn(name, count(F.col(text).cast("string")))
