"""Token ids by the tokenizers library, with the library asked once per distinct word of a block of texts.

A token of the byte-level pattern never crosses two kinds of places, as the pattern looks ahead but not back:

* before a blank or line end with a visible character after it: a run of white space gives up its last
  character, a blank goes to the word that follows and a line end stands alone;
* between a letter or digit and a punctuation mark or symbol behind it.

A text may thus be cut there, and the library gives the same ids for the parts as for the whole. Arrow
cuts the texts of a block and numbers their distinct parts, which are a small share; ids are gathered by
those numbers. Parts that begin with a blank or line end are joined again and encoded in a few calls; the
byte lengths of the tokens say where each ends, and a part whose end is not the end of a token stops the
job. Nothing is kept between blocks.

As by the library's own rule, an added token that stands in a text (such as ``<|endoftext|>``) is its single
id. Texts are parted there first; what lies between is cut and encoded as ordinary text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import slices

BLOCK_BYTES = 32 << 20
CALL_CHARS = 1 << 12
GATHER_WORDS = 1 << 20
# Parts begin with what they were cut before: a blank (which is dropped), a line end, or the sign for nothing.
_BARE = "\x01"
_MARK = r"([\pL\pN])([\pP\pS])"
# Texts with runs of white space, white space at the end or the sign are cut by a slower rule.
_ODD = r"\x01|[ \n](?:[\s\x0b\x1c-\x1f\x{85}\pZ]|$)"
_CUT = re.compile(r" (?=\S)|(?=\n\S)")
_open: dict[str, WordTokenizer] = {}

def default_tokenizer() -> str:
    """Path of the 50k byte-level vocabulary; it is installed on every node."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class WordTokenizer:
    """Ids of texts as bytes: little-endian unsigned integers of ``dtype``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        found = self.library.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized and self.library.normalizer for t in found.values()):
            raise ValueError("added tokens that take in what is beside them, or normalized text, are not served")
        self.added = {token.content: number for number, token in found.items()}
        # Of those that begin at a place the longest counts, as in the library.
        self.marks = "|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True))
        # Parts have no added token; joined for a call they must not make one either.
        self.ordinary = Tokenizer.from_file(path)
        self.ordinary.encode_special_tokens = True
        vocabulary = self.library.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.byte_lengths = np.zeros(self.size, np.int64)
        for token, number in vocabulary.items():
            self.byte_lengths[number] = len(token)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.ordinary.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype) for x in found]

    def _joined_ids(self, words: list[str]) -> list[bytes]:
        """Ids of parts that each begin with a blank or line end."""
        groups: list[list[str]] = []
        size = CALL_CHARS
        for word in words:
            if size >= CALL_CHARS:
                groups.append([])
                size = 0
            groups[-1].append(word)
            size += len(word)
        out, width = [], self.dtype.itemsize
        for some in range(0, len(groups), 64):
            part = groups[some : some + 64]
            for group, ids in zip(part, self._ids(["".join(g) for g in part])):
                ends = np.fromiter(accumulate(len(w.encode()) for w in group), np.int64, len(group))
                reached = np.cumsum(self.byte_lengths[ids])
                last = np.searchsorted(reached, ends)
                if not np.array_equal(reached[last], ends):
                    raise ValueError("a token reaches across a cut")
                data, stops = ids.tobytes(), ((last + 1) * width).tolist()
                out += [data[a:b] for a, b in zip([0, *stops], stops)]
        return out

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        bare = [i for i, p in enumerate(parts) if p[0] == _BARE]
        joined = [i for i, p in enumerate(parts) if p[0] != _BARE]
        out = [b""] * len(parts)
        for i, ids in zip(bare, self._ids([parts[i][1:] for i in bare]) if bare else []):
            out[i] = ids.tobytes()
        words = [p if (p := parts[i])[0] == "\n" else " " + p for i in joined]
        for i, ids in zip(joined, self._joined_ids(words)):
            out[i] = ids
        return out

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Order of the texts, their parts in that order, and the parts per text; a text has one at least."""
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        plain = pc.replace_substring(texts.filter(pa.array(~odd)), "\n", " \n")
        plain = pc.replace_substring_regex(plain, _MARK, r"\1 " + _BARE + r"\2")
        parts = pc.split_pattern(plain, " ")
        words, counts = parts.flatten(), np.diff(parts.offsets.to_numpy())
        if odd.any():
            cut = [_CUT.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
            # The sign at the start of a part would be read as such, so that text stays in one part.
            cut = [["".join(self._uncut(c))] if any(p[:1] == _BARE for p in c[1:]) else c for c in cut]
            counts = np.concatenate([counts, [len(c) for c in cut]])
            words = pa.concat_arrays([words, pa.array([w for c in cut for w in c], pa.large_string())])
        return np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]), words, counts

    @staticmethod
    def _uncut(parts: list[str]) -> Iterator[str]:
        yield parts[0]
        for part in parts[1:]:
            yield part if part[0] == "\n" else " " + part

    def encode(self, texts: Iterable[str] | pa.Array) -> list[bytes]:
        """Ids of each text, which may be a list or an Arrow column without nulls."""
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        if not len(texts):
            return []
        if self.marks:
            marked = np.zeros(len(texts), bool)
            for content in self.added:
                marked |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
            if marked.any():
                return self._encode_marked(texts, marked)
        return self._encode_ordinary(texts)

    def _encode_marked(self, texts: pa.Array, marked: np.ndarray) -> list[bytes]:
        """Ids of texts some of which have added tokens: every second part of those is one."""
        parts = [re.split(f"({self.marks})", t) for t in texts.filter(pa.array(marked)).to_pylist()]
        between = pa.array([p for part in parts for p in part[::2]], pa.large_string())
        found = iter(self._encode_ordinary(pa.concat_arrays([between, texts.filter(pa.array(~marked))])))
        single = {c: np.array([number], self.dtype).tobytes() for c, number in self.added.items()}
        out = [b""] * len(texts)
        for at, part in zip(np.flatnonzero(marked).tolist(), parts):
            out[at] = b"".join(single[p] if i % 2 else next(found) for i, p in enumerate(part))
        for at in np.flatnonzero(~marked).tolist():
            out[at] = next(found)
        return out

    def _encode_ordinary(self, texts: pa.Array) -> list[bytes]:
        order, words, counts = self._cut(texts)
        ends = np.cumsum(counts)
        after = np.ones(len(words), bool)
        after[ends - counts] = False
        distinct = words.filter(pa.array(after)).dictionary_encode()
        first = words.take(pa.array(ends - counts)).to_pylist()
        del words
        number = np.empty(len(after), np.int32)
        number[after] = distinct.indices.to_numpy()
        number[ends - counts] = len(distinct.dictionary) + np.arange(len(texts))
        table = self._encode_parts(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())
        table += [x.tobytes() for x in self._ids(first)]
        lengths = np.fromiter(map(len, table), np.int64, len(table)) // self.dtype.itemsize
        begins, ids = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(table), self.dtype)
        out, at = [b""] * len(texts), 0
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GATHER_WORDS)))
            low = int(ends[at - 1]) if at else 0
            some = number[low : ends[upto - 1]]
            sizes = lengths[some]
            reached = np.cumsum(sizes)
            places = np.repeat(begins[some] - (reached - sizes), sizes)
            places += np.arange(len(places))
            data = ids.take(places).tobytes()
            stops = (reached[ends[at:upto] - 1 - low] * self.dtype.itemsize).tolist()
            for text, a, b in zip(order[at:upto].tolist(), [0, *stops], stops):
                out[text] = data[a:b]
            at = upto
        return out


def blocks(batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, in batches of about ``limit`` bytes: larger ones are parted, smaller ones joined."""
    held, size = [], 0
    for batch in slices(batches, "text", limit):
        if held and size + batch.nbytes > limit:
            yield _one(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield _one(held)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this worker for ``path``; workers serve many tasks."""
    if path not in _open:
        _open[path] = WordTokenizer(path)
    return _open[path]
