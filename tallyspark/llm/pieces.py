"""SentencePiece encoding and decoding with a byte-pair model, by a table of each prefix's last token.

For a word, `last[i]` is the last token of the encoding of its first i characters. It is unique: of the vocabulary's pieces that end at
i (found by an Aho-Corasick automaton), it is the one whose start has a last token with which it is compatible: merging the two pieces'
characters on their own leaves exactly these two. The ids are recovered from the end backwards. A piece's own merges are noted once, with
the symbol they leave at its right and left end; a pair is compatible if, in the order of scores, no merge across its border comes first.
Answers are remembered, as are the ids of words; both memories are dropped when they reach a fixed size.

A text is cut before each space that follows something else: no piece has a space behind another character, so no merge crosses there.
Characters outside the vocabulary become byte tokens. A null text is empty; an empty text has the begin and end ids alone; texts of any
length are whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from .batches import releasing, slices

SPACE = "▁"
WORDS_KEPT = 100_000  # in each of two generations
LONGEST_KEPT = 40
PAIRS_KEPT = 400_000
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$")
TOKENS = "doc_id string, n_tokens bigint, ids binary, decoded string"


class PieceModel:
    """The pieces of a model file and the two directions. Only models that leave texts as they are but for spaces are accepted."""

    def __init__(self, path: str):
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        self.bos, self.eos = lib.bos_id(), lib.eos_id()
        names = [lib.id_to_piece(i) for i in range(n)]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(n)]
        self.id_of = {p: i for i, p in enumerate(names) if not special[i] and not lib.is_unused(i)}
        self.score = {p: lib.get_score(i) for p, i in self.id_of.items()}
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of) or any(lib.is_unused(i) for i in range(n)):
            raise ValueError("a model with pieces that hold inner spaces or are not to be used can't be cut at spaces")
        self.byte_ids = {i: int(names[i][3:5], 16) for i in range(n) if lib.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_ids.items()}
        self.surface = [b"" if special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        for i, b in self.byte_ids.items():
            self.surface[i] = bytes([b])
        self.names = names
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.characters = {p for p in self.id_of if len(p) == 1}
        self.histories: dict[int, tuple] = {}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # encoding

    def merged(self, text: str, seen=None) -> list[str]:
        """Plain byte-pair merging: the best-scored pair first, the leftmost of equals. `seen` gets the score and both ends of each step."""
        parts, right, left = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list[tuple] = []
        tail = len(parts) - 1

        def offer(i):
            j = right[i]
            if j < len(parts) and (score := self.score.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-score, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            score, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j >= len(parts) or parts[j] != b:
                continue
            parts[i], parts[j], right[i] = a + b, "", right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            if j == tail:
                tail = i
            if seen is not None:
                seen.append((-score, parts[0], parts[tail]))
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        return [p for p in parts if p]

    def history(self, token: int) -> tuple:
        """(whole, scores, left ends, right ends) of the merges that build a piece from its characters; ends have one entry more."""
        known = self.histories.get(token)
        if known is None:
            name, steps = self.names[token], []
            whole = len(self.merged(name, steps)) == 1
            known = self.histories[token] = (whole, [s for s, _, _ in steps], [name[0], *(a for _, a, _ in steps)], [name[-1], *(b for _, _, b in steps)])
        return known

    def compatible(self, first: int, second: int) -> bool:
        """Whether merging both pieces' characters leaves the two pieces."""
        whole, a_scores, _, a_ends = self.history(first)
        whole_too, b_scores, b_ends, _ = self.history(second)
        if not (whole and whole_too):
            return False
        i = j = 0
        while True:
            across = self.score.get(a_ends[i] + b_ends[j])
            a = a_scores[i] if i < len(a_scores) else None
            b = b_scores[j] if j < len(b_scores) else None
            # of equal scores the leftmost merge comes first: inside the first piece, across, inside the second
            if across is not None and (a is None or across > a) and (b is None or across >= b):
                return False
            if a is None and b is None:
                return True
            if b is None or (a is not None and a >= b):
                i += 1
            else:
                j += 1

    def _fits(self, first: int, second: int) -> bool:
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        fits = self.pairs[first << 32 | second] = self.compatible(first, second)
        return fits

    def word_ids(self, word: str) -> list[int]:
        """Ids of a word (spaces as the piece sign); characters without a piece, next to which nothing merges, become byte tokens."""
        if self.characters.issuperset(word):
            return self._covered_ids(word)
        out, begin = [], 0
        for i, c in enumerate(word):
            if c not in self.characters:
                if begin < i:
                    out += self._covered_ids(word[begin:i])
                out += [self.id_of_byte[b] for b in c.encode("utf-8", "surrogatepass")]
                begin = i + 1
        return out + self._covered_ids(word[begin:]) if begin < len(word) else out

    def _covered_ids(self, word: str) -> list[int]:
        """last[i] is the last token of the prefix that ends with character i, size[i] its length; last[-1] stands for the empty prefix."""
        n, pairs = len(word), self.pairs
        last, size = [None] * n + [-1], [0] * n
        for end, (length, token) in self.automaton.iter(word):
            if last[end] is None and (before := last[end - length]) is not None:
                if before >= 0:
                    fits = pairs.get(before << 32 | token)
                    if not (self._fits(before, token) if fits is None else fits):
                        continue
                elif not self.history(token)[0]:
                    continue
                last[end], size[end] = token, length
        out, end = [], n - 1
        while end >= 0:
            out.append(last[end])
            end -= size[end]
        out.reverse()
        return out

    def encode_bytes(self, text: str) -> bytes:
        """All ids, begin and end included, as little-endian unsigned 32-bit integers."""
        known, out = self.words, [self.bos.to_bytes(4, "little")]
        if text:
            for word in WORD.findall(SPACE + text.replace(" ", SPACE)):
                ids = known.get(word)
                if ids is None:
                    ids = self.older.get(word) or np.array(self.word_ids(word), "<u4").tobytes()
                    if len(word) <= LONGEST_KEPT:
                        if len(known) >= WORDS_KEPT:
                            self.older = known
                            known = self.words = {}
                        known[word] = ids
                out.append(ids)
        out.append(self.eos.to_bytes(4, "little"))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    # decoding

    def decode(self, ids: list[int]) -> str:
        """The library's decoding: the first space goes, control ids are empty, bytes that are no character become U+FFFD."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        first = next((i for i in ids if self.surface[i]), None)
        if first is not None and first not in self.byte_ids and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """One model per worker process."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def tokenize(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep_words: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) per row; ids are packed as little-endian unsigned 32-bit integers.

    A worker keeps the words it has seen for its next tasks. Without `keep_words` they go when a task is done: slower, but other stages find
    the memory free.
    """
    def run(batches):
        pieces = model(model_path)
        for batch in slices(batches):
            packed = [pieces.encode_bytes(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary()),
                pa.array([pieces.decode(np.frombuffer(p, "<u4").tolist()) for p in packed], pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])
        if not keep_words:
            pieces.words, pieces.older = {}, {}

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(releasing(run), TOKENS)
    return rows.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_tokens", "ids", "decoded")


def token_digests(tokens: DataFrame) -> DataFrame:
    return tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
