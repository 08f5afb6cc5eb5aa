"""Token ids of whole texts by the ``tokenizers`` library, without repeated work.

A text falls into chunks at its white space, at places where the tokenizer's own
splitting never joins what stands on either side. The ids of a text are those of
its chunks in order, and a batch of texts holds each chunk many times: chunks are
counted off by Arrow's dictionary encoding and only distinct ones reach the
library. Simple chunks (Latin letters, one mark behind) go to the library's model
as pre-tokens, all others through its whole pipeline.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The white space of Unicode, as the tokenizers' patterns know it.
WHITE = "\t-\r \x85\xa0  -     　"
# A space that does not follow a character other than white space cannot be cut before.
_UNSAFE = "[\t\n\x0b\x0c\r \u0085   -     　] |\x00"
_CHUNKS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_MARKS = frozenset(".,;:!?")
# A letter with an ASCII mark behind it: a run of letters ends there in any splitting by classes.
_ENDS = "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff])([!-/:-@\\[-`{-~])"
# White space that is not alone.
_DOUBLE = f"[{WHITE}][{WHITE}]"
# Pre-tokens remembered by one worker, in two halves: when the newer one is full it takes the
# place of the older, so memory is bounded and what comes often stays.
CACHE = 800_000
# Whole chunks remembered; cleared when full.
HARD_CACHE = 100_000
# Longer chunks are encoded anew each time they come.
LONGEST_KEPT = 64


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class Encoder:
    """Ids of chunks; ``spaced`` tells whether a leading space is part of a pre-token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        # Vocabularies that mark word ends drop white space and fold case.
        self.spaced = not getattr(self.model, "end_of_word_suffix", None)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        rules = json.loads(self.tokenizer.to_str())
        split = rules["pre_tokenizer"] or {}
        # Splitting by classes of characters alone, where letters, marks and a lone white space part.
        self._by_class = (
            rules["normalizer"] is None and split.get("type") == "ByteLevel"
            and split["use_regex"] and not split["add_prefix_space"]
        )
        self._added = [t["content"] for t in rules["added_tokens"]]
        self._letters = byte_letters()
        self._space = self._letters[0x20]
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        # Whole chunks that only the full pipeline encodes, under the chunk as it stands.
        self._hard: dict[str, bytes] = {}

    def _pretoken(self, word: str) -> bytes:
        ids = self._known.get(word)
        if ids is None:
            ids = self._older.get(word)
            if ids is None:
                if word.isascii():
                    # A pre-token has at most a space in front; other ASCII characters of it
                    # stand for themselves.
                    spelled = self._space + word[1:] if word[0] == " " else word
                else:
                    spelled = word.encode().decode("latin-1").translate(self._letters)
                ids = array("i", [t.id for t in self.model.tokenize(spelled)]).tobytes()
            if len(self._known) >= CACHE // 2:
                self._known, self._older = {}, self._known
            self._known[word] = ids
        return ids

    def chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, number of ids per chunk)."""
        found: list[bytes] = []
        hard: list[int] = []
        known, pretoken, spaced = self._known.get, self._pretoken, self.spaced
        encoded = self._hard.get
        for i, chunk in enumerate(chunks):
            word = chunk if spaced else chunk.lower()
            ids = known(word)
            if ids is None:
                mark = word[-1:] if word[-1:] in _MARKS else ""
                body = word[:-1] if mark else word
                letters = body[1:] if body[:1] == " " else body
                if not (letters.isalpha() and (letters.isascii() or max(letters) < "\u0100")):
                    ids = encoded(chunk)
                    if ids is None:
                        hard.append(i)
                        ids = b""
                elif mark:
                    ids = (known(body) or pretoken(body)) + pretoken(mark)
                else:
                    ids = pretoken(body)
            found.append(ids)
        if hard:
            whole = self.tokenizer.encode_batch(
                [chunks[i] for i in hard], add_special_tokens=False
            )
            if len(self._hard) + len(hard) > HARD_CACHE:
                self._hard.clear()
            keep = len(hard) <= HARD_CACHE
            for i, e in zip(hard, whole):
                found[i] = array("i", e.ids).tobytes()
                if keep and len(chunks[i]) <= LONGEST_KEPT:
                    self._hard[chunks[i]] = found[i]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.int32), sizes

    def chunks(self, texts: pa.Array, fine: bool = False) -> tuple[pa.Array, np.ndarray]:
        """(chunks of all texts, chunks per text); a NULL text has none.

        ``fine``: cut as well behind letters and at lone line ends, where the tokenizer
        does; more chunks, of which fewer are distinct.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.spaced:
            parts = pc.ascii_split_whitespace(texts)
            return parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts)
        if fine and self._by_class:
            plain = self._finely(plain)
        parts = pc.split_pattern(pc.replace_substring(plain, " ", "\x00 "), "\x00")
        sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = parts.flatten()
        if not odd.any():
            return flat, sizes
        # Texts with longer runs of white space are cut one by one.
        at = np.concatenate([[0], np.cumsum(sizes)])
        pieces, start = [], 0
        for i in np.flatnonzero(odd):
            own = pa.array(_CHUNKS.findall(texts[int(i)].as_py()), flat.type)
            pieces += [flat.slice(start, at[i] - start), own]
            start, sizes[i] = at[i + 1], len(own)
        pieces.append(flat.slice(start))
        return pa.concat_arrays(pieces), sizes

    def _finely(self, texts: pa.Array) -> pa.Array:
        """Texts with a mark of a cut behind letters and around line ends that stand alone."""
        whole = pa.array(np.zeros(len(texts), bool))
        for token in self._added:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        cut = pc.replace_substring_regex(texts, _ENDS, "\\1\x00\\2")
        lines = pc.replace_substring(cut, "\n", "\x00\n\x00")
        cut = pc.if_else(pc.match_substring_regex(texts, _DOUBLE), cut, lines)
        return pc.if_else(whole, texts, cut)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids per text)."""
        flat, per_text = self.chunks(texts, fine=True)
        coded = flat.dictionary_encode()
        ids, sizes = self.chunk_ids(listed(coded.dictionary))
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        out = gather(ids, sizes, which)
        at = np.concatenate([[0], np.cumsum(sizes[which])])
        ends = np.concatenate([[0], np.cumsum(per_text)])
        return out, np.diff(at[ends])


def listed(texts: pa.Array) -> list[str]:
    """The values of an array of strings, split from one string where no NUL is in them."""
    if not len(texts):
        return []
    rows = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts)
    found = pc.binary_join(rows, pa.scalar("\x00", texts.type))[0].as_py().split("\x00")
    return found if len(found) == len(texts) else texts.to_pylist()


def gather(values: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Concatenate the runs ``which`` of ``values``, where run i has ``sizes[i]`` values."""
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[which]
    total = int(lengths.sum())
    begin = np.cumsum(lengths) - lengths
    index = np.arange(total, dtype=np.int64)
    index += np.repeat(starts[which] - begin, lengths)
    return values[index]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# Characters that one round of encoding takes at once, which bounds a worker's memory.
ROUND = 3_000_000


def rounds(batch: pa.RecordBatch, text: str, limit: int = ROUND) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` bytes of text, at least a row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, done + limit, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop
        # What Arrow keeps for the next round adds up over the workers of an executor.
        pa.default_memory_pool().release_unused()
