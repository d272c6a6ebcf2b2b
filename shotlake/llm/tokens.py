"""Token ids of texts as the tokenizers library gives them, and counts of huge texts by overlapping chunks."""

from __future__ import annotations

import array
import json
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Name of the vocabulary file in public_tokenizers.
VOCABULARY = "word_bpe_49k.json"
#: Distinct words whose ids a worker remembers before it starts afresh.
REMEMBERED = 600_000
#: Bytes of a chunk of a long text, and of what two chunks have in common.
CHUNK, OVERLAP = 4_096, 256
# How a vocabulary file must normalise and split text for words to be counted by themselves.
NORMALIZER = r"""{"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}"""
PRE_TOKENIZER = r"""{"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": true}, {"type": "ByteLevel", "add_prefix_space": false, "trim_offsets": true, "use_regex": false}]}"""
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


#: A word of ASCII and Latin-1 lower-case letters, then any ASCII marks but the apostrophe: the pre-tokenizer
#: makes its letters one piece and its marks another.
PLAIN = re.compile(rb"((?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)")


class Words:
    """Ids of white-space separated words, each encoded once by the library.

    Valid for vocabularies with the NORMALIZER and PRE_TOKENIZER above, which never join characters across white
    space and drop it: the ids of a text are then those of its words in a row. With any other (`by_words` false), the
    library gets whole texts: tokenizers for .json files, sentencepiece for .model files. Words are split at the six ASCII white-space
    bytes only. ASCII letters are lowered first, as the vocabulary's normalizer would do, unless the text holds
    combining marks (composition could differ) or the opening of a special string.
    """

    def __init__(self, vocabulary: str = VOCABULARY, remembered: int = REMEMBERED):
        import os

        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = public_tokenizers.path(vocabulary)
        self.by_words = False
        if str(path).endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            self.whole = SentencePieceProcessor(model_file=str(path)).encode
        else:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(str(path))
            self.library.no_truncation()
            self.library.no_padding()
            self.whole = lambda text: self.library.encode(text, add_special_tokens=False).ids
            with open(path, encoding="utf-8") as f:
                self.by_words = fits(json.load(f))
        self.remembered = remembered
        self.counts: dict[bytes, int] = {}
        self.packed: dict[bytes, bytes] = {}
        # by what is asked of ids (their number or bytes): that of marks, to be added to that of letters
        self.marks: dict[Callable, dict[bytes, object]] = {}
        # byte-level alphabet: bytes without a visible Latin-1 character of their own count on from 256
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.visible = dict(zip(own, own)) | {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in set(own))}

    @staticmethod
    def split(data: bytes) -> list[bytes]:
        # the two bytes that begin U+0300 to U+036F
        if b"<|" in data or b"\xcc" in data or b"\xcd" in data:
            return data.split()
        return data.lower().split()

    def _learn(self, words: list[bytes], known: dict, value: Callable[[list[int]], object]) -> None:
        new = {w for w in words if w not in known}
        if len(known) + len(new) > self.remembered:
            known.clear()
            new = set(words)
        odd, marked, marks_of = [], [], self.marks.setdefault(value, {})

        def of(letters: bytes) -> object:
            return value([t.id for t in self.library.model.tokenize(letters.decode("latin-1").translate(self.visible))])

        for w in new:
            m = None if w.isalpha() and w.islower() else PLAIN.fullmatch(w)
            if m and m[2]:
                marked.append((w, *m.groups()))
            elif m or w.isalpha() and w.islower():
                known[w] = of(w)
            else:
                odd.append(w)
        # words that differ by the marks that follow them share their letters' ids, which are a word of their own
        for w, letters, marks in marked:
            if letters not in known:
                known[letters] = of(letters)
            known[w] = known[letters] + self._marks(marks, marks_of, value)
        found = self.library.encode_batch_fast([w.decode() for w in odd], add_special_tokens=False)
        known.update((w, value(e.ids)) for w, e in zip(odd, found))

    def _marks(self, marks: bytes, known: dict, value: Callable[[list[int]], object]) -> object:
        if marks not in known:
            if len(known) > 10_000:
                known.clear()
            known[marks] = value(self.library.encode(marks.decode(), add_special_tokens=False).ids)
        return known[marks]

    def _counts(self, data: bytes) -> list[int]:
        words = self.split(data)
        try:
            return list(map(self.counts.__getitem__, words))
        except KeyError:
            self._learn(words, self.counts, len)
            return list(map(self.counts.__getitem__, words))

    def encode(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Of each word its offset in data and the number of its ids."""
        space = _SPACE[np.frombuffer(data, np.uint8)]
        starts = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)) == -1)
        return starts, np.array(self._counts(data), np.int64)

    def count(self, data: bytes, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Number of ids of a text given as UTF-8: by chunks that resynchronise, where it is longer than one."""
        if not self.by_words:
            return len(self.whole(data.decode()))
        return count_by_chunks(data, self.encode, chunk, overlap) if len(data) > chunk else sum(self._counts(data))

    def ids(self, data: bytes) -> bytes:
        """Ids of a text given as UTF-8, as unsigned little-endian 32-bit numbers."""
        if not self.by_words:
            return little_endian(self.whole(data.decode()))
        words = self.split(data)
        try:
            return b"".join(map(self.packed.__getitem__, words))
        except KeyError:
            self._learn(words, self.packed, little_endian)
            return b"".join(map(self.packed.__getitem__, words))


def little_endian(ids: list[int]) -> bytes:
    a = array.array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


def fits(spec: dict) -> bool:
    """Whether a tokenizer file is one whose words can be encoded by themselves."""
    added = all(t["special"] and not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])) and t["content"].startswith("<|") for t in spec["added_tokens"])
    return added and spec["normalizer"] == json.loads(NORMALIZER) and spec["pre_tokenizer"] == json.loads(PRE_TOKENIZER) and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")


def _whole(data: bytes, at: int) -> int:
    """at, or where the character that it lies in begins."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def count_by_chunks(data: bytes, encode: Callable[[bytes], tuple[np.ndarray, np.ndarray]], chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text (as UTF-8) too long to encode at once.

    encode gives offsets in a piece at which tokens start, ascending, and how many tokens there are from each to
    the next. Chunk B begins `overlap` before the end of chunk A. A position is a proven stable common boundary if
    white space stands before it and both chunks have a token start there: tokens never cross white space, so what
    follows is encoded alike in either. A's tokens count up to the last such position, B's from there on. Where
    the overlap holds none, it is doubled; once it would reach A's own start, A is encoded anew with twice the length.
    """
    n, total, start = len(data), 0, 0
    end = _whole(data, min(max(chunk, 4), n))
    starts, counts = encode(data[:end])
    while end < n:
        wide, width, cut = max(overlap, 4), end - start, None
        while cut is None and wide < width:
            at = _whole(data, end - wide)
            last = _whole(data, min(at + max(chunk, 2 * wide), n))
            after, more = encode(data[at:last])
            both = np.intersect1d(starts + start, after + at)
            both = [x for x in both[(both > at) & (both < end)].tolist() if _SPACE[data[x - 1]]]
            cut = both[-1] if both else None
            wide *= 2
        if cut is None:
            end = _whole(data, min(start + 2 * width, n))
            starts, counts = encode(data[start:end])
            continue
        total += int(counts[starts + start < cut].sum())
        kept = after + at >= cut
        starts, counts = after[kept] - (cut - at), more[kept]
        start, end = cut, last
    return total + int(counts.sum())


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, limit: int = 2048, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, whole texts, no special tokens added.

    A null text counts as empty: 0 bytes, 0 tokens. A null id stays null. Repeated rows give repeated results;
    an empty table gives an empty one. Other columns are dropped, so none can clash. Texts over `chunk` bytes are
    counted by count_by_chunks; shorter ones are a single chunk of the same encoder.
    """
    from shotlake.llm.common import id_and_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(vocabulary)
        for batch in batches:
            texts = [value.as_py() for value in batch.column(1).cast(pa.binary())]
            counts = [words.count(t, chunk, overlap) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
