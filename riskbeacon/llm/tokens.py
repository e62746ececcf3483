"""Token ids of whole texts with the ``tokenizers`` library, piece by piece.

A text is cut only where the tokenizer's own pre-tokenizer always cuts, so
the ids of the pieces, joined, are the ids of the text. Equal pieces of a
batch are encoded once, and pieces that repeat are remembered in the worker
(a bounded table). Texts in which the cuts aren't known to be safe (runs of
white space, special-token strings) go to the library whole, or in parts of
``PART_CHARS`` cut between a letter or digit, one blank and a letter or digit.
Texts for a pre-tokenizer of another kind are never cut.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from riskbeacon.llm.common import segment_sums, slices_by_bytes

SEP = "\x01"
REMEMBERED = 280_000      # pieces that a worker remembers at most
SLICE_BYTES = 8 << 20     # texts worked on at once
BATCH_BYTES = 1 << 20     # bytes of one call of the library
COUNT_BYTES = 1 << 18     # the same, where lengths are wanted: a call holds a result a piece
PART_CHARS = 1 << 16      # parts of long texts that go to the library
_WS = "[\\s\\x0b\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
_CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
# A letter or digit and a mark after it, which the byte-level pre-tokenizer
# keeps apart whatever follows; an apostrophe may start a contraction.
_MARK = "([A-Za-z0-9\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF])([!-&(-/:-@\\[-`{-~])"
JOIN_CHARS = 1 << 14      # pieces, joined by line feeds, of one text for the library
# Places of pieces joined by line feeds where the white space isn't one line
# feed, alone or before the blank of a blank-led piece.
_CLASH = re.compile(r"[^\S\n]\s|\n[^\S ]|\s\Z")
_ENCODERS: dict[tuple[str, bool], "PieceEncoder"] = {}


def encoder(path: str, remembered: int = REMEMBERED, ids: bool = True) -> "PieceEncoder":
    """The worker's encoder for a tokenizer file; without ``ids`` one that
    takes and remembers lengths only."""
    if (path, ids) not in _ENCODERS:
        _ENCODERS[path, ids] = PieceEncoder(path, ids)
    _ENCODERS[path, ids].most = remembered
    return _ENCODERS[path, ids]


def byte_batches(texts: list[str], most: int = BATCH_BYTES):
    """Consecutive lists of about ``most`` characters each."""
    batch, size = [], 0
    for t in texts:
        if batch and size + len(t) > most:
            yield batch
            batch, size = [], 0
        batch.append(t)
        size += len(t)
    if batch:
        yield batch


def safe_parts(text: str, most: int = PART_CHARS) -> list[str]:
    """Cut a long text at single blanks between letters or digits."""
    parts, at = [], 0
    while len(text) - at > most:
        m = _CUT.search(text, at + most)
        if m is None:
            break
        parts.append(text[at:m.start()])
        at = m.start()
    return [*parts, text[at:]]


class PieceEncoder:
    def __init__(self, path: str, ids: bool = True):
        self.ids = ids
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tk = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and " " not in t["content"]
                    for t in spec.get("added_tokens", []))
        if plain and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") \
                and not spec.get("normalizer"):
            self.kind = "blank-led"      # a blank belongs to the word after it
        elif plain and pre.get("type") == "Sequence" and pre["pretokenizers"][0].get("invert") \
                and pre["pretokenizers"][0].get("behavior") == "Removed":
            self.kind = "blank-dropped"  # white space only separates
        else:
            self.kind = "whole"
        self.most = REMEMBERED
        self.line_feed = self.tk.encode("\n", add_special_tokens=False).ids if self.kind == "blank-led" else []
        self.known = pa.array([], pa.string())
        self.met = np.zeros(1 << 24, bool)  # by hash, pieces met so far
        self.lens = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    # ---- cutting -----------------------------------------------------------
    def _unsafe(self, texts: pa.Array) -> np.ndarray:
        if self.kind == "whole":
            return np.ones(len(texts), bool)
        bad = pc.match_substring(texts, SEP)
        for s in self.special:
            bad = pc.or_(bad, pc.match_substring(texts, s))
        if self.kind == "blank-led":
            bad = pc.or_(bad, pc.match_substring_regex(texts, _WS + _WS))
        return bad.to_numpy(zero_copy_only=False)

    def _pieces(self, texts: pa.Array) -> pa.ListArray:
        if self.kind == "blank-led":
            t = pc.replace_substring_regex(texts, _MARK, "\\1" + SEP + "\\2")
            t = pc.replace_substring(pc.replace_substring(t, " ", SEP + " "), "\n", SEP + "\n" + SEP)
            return pc.split_pattern(t, SEP)
        t = pc.replace_substring_regex(pc.ascii_lower(texts), "([a-z0-9])([.,])", "\\1 \\2")
        return pc.ascii_split_whitespace(t)

    # ---- encoding ----------------------------------------------------------
    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of each text by the library; no ids where lengths are wanted."""
        lens, ids = [], []
        if not self.ids:
            for batch in byte_batches(texts, COUNT_BYTES):
                lens.extend(map(len, self.tk.encode_batch_fast(batch, add_special_tokens=False)))
            return np.array(lens, np.int64), np.zeros(0, np.uint32)
        for batch in byte_batches(texts):
            got = [e.ids for e in self.tk.encode_batch_fast(batch, add_special_tokens=False)]
            lens.append(np.fromiter(map(len, got), np.int64, len(got)))
            ids.append(np.fromiter(chain.from_iterable(got), np.uint32, int(lens[-1].sum())))
        none = np.zeros(0, np.int64)
        return np.concatenate(lens or [none]), np.concatenate(ids or [none.astype(np.uint32)])

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of blank-led pieces, many joined by line feeds in one text.

        The pre-tokenizer keeps such a line feed apart, and no other token is
        a line feed alone, so the ids are cut at its id. Pieces whose own
        white space would meet a line feed go to the library one by one.
        """
        chars = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        cuts = np.flatnonzero(np.diff(chars // JOIN_CHARS)) + 1
        lens, ids = [], []
        for a, b in zip([0, *cuts], [*cuts, len(words)]):
            text = "\n".join(words[a:b])
            if _CLASH.search(text):
                n, got = self._library(words[a:b])
            else:
                raw = self.tk.encode_batch_fast([text], add_special_tokens=False)[0].ids
                got = np.fromiter(raw, np.uint32, len(raw))
                feed = got == self.line_feed[0]
                at = np.concatenate(([-1], np.flatnonzero(feed), [len(got)]))
                n, got = np.diff(at) - 1, got[~feed]
            lens.append(n)
            ids.append(got)
        return np.concatenate(lens), np.concatenate(ids)

    def _new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of pieces that aren't remembered."""
        return self._joined(words) if self.ids and words and len(self.line_feed) == 1 else self._library(words)

    def _again(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Which new pieces to remember: any at first, later those that were met before."""
        at = np.fromiter(map(hash, words), np.int64, len(words)) & (len(self.met) - 1)
        keep = (counts > 1) | self.met[at]
        self.met[at] = True
        if len(self.known) < self.most // 4:
            return np.arange(len(words))
        return np.flatnonzero(keep)

    def _distinct(self, words: pa.StringArray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of distinct pieces, the remembered ones first looked up."""
        slot = pc.index_in(words, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(slot < 0)
        unknown = words.take(pa.array(new))
        texts = unknown.to_pylist()
        new_lens, new_ids = self._new(texts)
        # lengths and starts over [remembered | new]
        lens = np.concatenate((self.lens, new_lens))
        starts = np.concatenate(([0], np.cumsum(lens)))[:-1]
        flat = np.concatenate((self.flat, new_ids))
        slot[new] = len(self.lens) + np.arange(len(new))
        keep = self._again(texts, counts[new])[:max(0, self.most - len(self.known))]
        if len(keep):
            pos = len(self.lens) + keep
            self.known = pa.concat_arrays([self.known, unknown.take(pa.array(keep))])
            if self.ids:
                self.flat = np.concatenate((self.flat, gather(flat, starts[pos], lens[pos])))
            self.lens = np.concatenate((self.lens, lens[pos]))
        return lens[slot], (starts[slot], flat)

    def _encode_slice(self, texts: pa.Array):
        unsafe = self._unsafe(texts)
        n = len(texts)
        safe = texts.filter(pa.array(~unsafe)) if unsafe.any() else texts
        lists = self._pieces(safe)
        code = lists.flatten().dictionary_encode()
        codes = code.indices.to_numpy()
        off = lists.offsets.to_numpy().astype(np.int64)
        off = off - off[0]
        words = code.dictionary
        wlens, (wstarts, flat) = self._distinct(words, np.bincount(codes, minlength=len(words)))
        per = wlens[codes]
        counts = np.zeros(n, np.int64)
        counts[~unsafe] = segment_sums(per, off)
        ids_of_safe = gather(flat, wstarts[codes], per) if self.ids else None
        if not unsafe.any():
            return counts, ids_of_safe
        at = np.flatnonzero(unsafe)
        parts = [[t] if self.kind == "whole" else safe_parts(t) for t in texts.filter(pa.array(unsafe)).to_pylist()]
        lens, ids = self._library([p for ps in parts for p in ps])
        poff = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        counts[at] = segment_sums(lens, poff)
        if not self.ids:
            return counts, None
        out = np.zeros(int(counts.sum()), np.uint32)
        of_unsafe = np.repeat(unsafe, counts)
        out[of_unsafe], out[~of_unsafe] = ids, ids_of_safe
        return counts, out

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        got = [self._encode_slice(texts.slice(a, b - a))[0] for a, b in slices_by_bytes(texts, SLICE_BYTES)]
        return np.concatenate(got) if got else np.zeros(0, np.int64)

    def encode(self, texts: pa.Array):
        """Yields (first row, lengths, ids) for consecutive rows."""
        for a, b in slices_by_bytes(texts, SLICE_BYTES):
            counts, ids = self._encode_slice(texts.slice(a, b - a))
            yield a, counts, ids


def gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """flat[s:s+n] of each (s, n), joined."""
    total = int(lens.sum())
    if not total:
        return flat[:0]
    before = np.cumsum(lens) - lens
    return flat[np.repeat(starts - before, lens) + np.arange(total)]
