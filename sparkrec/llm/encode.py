"""Exact, faster use of a tokenizers file: each distinct pre-token of a block is encoded once and remembered.

Pre-tokens are encoded independently of each other, and text repeats them, so
a bounded memo serves most.  Each way gives the ids that the library gives for
the whole text:

* texts of one-byte (Latin-1) characters without apostrophes are cut into
  pre-tokens with NumPy, many documents at a time;
* other texts are cut only where white space follows a non-white character,
  which no pre-token of the two known kinds crosses;
* texts with unusual white space, and files with another pre-tokenizer, are
  encoded whole.

With ``added_tokens`` these are the ids of an unchanged ``Tokenizer.from_file``:
an added token of the file inside a text (``<|endoftext|>``) is its one id, and
a text that holds one is encoded whole.  Without, such strings are ordinary text
(``encode_special_tokens``).
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from itertools import accumulate, chain

import numpy as np

from sparkrec.llm.common import slices
from sparkrec.llm.shingles import BASE, U, mix

SEGMENT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
UNUSUAL_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")
# Fixed value: the word vocabulary's pre-token rule.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: One-byte characters that the NumPy cut leaves to the others: apostrophe, unusual white space, raised digits.
LEFT_OUT = b"'\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\xb2\xb3\xb9\xbc\xbd\xbe"
WHITE, LETTER, DIGIT, OTHER = range(4)
KIND = np.array([WHITE if chr(c) in " \n" else LETTER if chr(c).isalpha() else DIGIT if chr(c).isdecimal() else OTHER
                 for c in range(256)], np.uint8)

MEMO_BYTES = 48 << 20
ENTRY_BYTES = 200  # of an entry besides its characters and ids
MEMO_CHARS = 64
BLOCK_CHARS = 1 << 22
#: Masks of the first 0 to 8 bytes of a little-endian word.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def distinct_tokens(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of one token of each kind, kind of each token) of the tokens ``data[first:last]``, told apart by their bytes.

    Tokens of up to 16 bytes are two machine words and a length: sorted by a
    hash of them, then compared in full with the first of their kind (and sorted
    by the words themselves if a hash ever joins two kinds).  Longer tokens are
    looked up as bytes.
    """
    size = last - first
    short, long = np.flatnonzero(size <= 16), np.flatnonzero(size > 16)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = np.ndarray((len(data) + 8,), "<u8", padded, 0, (1,))
    n = size[short]
    low = words[first[short]] & MASKS[np.minimum(n, 8)]
    high = words[np.minimum(first[short] + 8, len(data))] & MASKS[np.maximum(n - 8, 0)]
    key = mix(low ^ mix(high + n.astype(U) * U(BASE)))
    _, at, kind = np.unique(key, return_index=True, return_inverse=True)
    if not all(np.array_equal(x[at][kind], x) for x in (low, high, n)):
        order = np.lexsort((n, high, low))
        new = np.ones(len(order), bool)
        new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (low, high, n)], axis=0)
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(new) - 1
        at = order[new]
    kinds = np.empty(len(size), np.int64)
    kinds[short] = kind
    names: dict[bytes, int] = {}
    places = []
    for i in long.tolist():
        token = data[first[i]:last[i]].tobytes()
        if token not in names:
            names[token] = len(at) + len(names)
            places.append(i)
        kinds[i] = names[token]
    return np.concatenate([short[at], np.array(places, np.int64)]), kinds


def gather(table: list[bytes], kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, running count) of the tokens ``kinds``, whose ids ``table`` holds as little-endian bytes."""
    flat = np.frombuffer(b"".join(table), "<u4")
    sizes = np.array([len(x) // 4 for x in table], np.int64)
    offsets = np.cumsum(sizes) - sizes
    counts = sizes[kinds]
    total = np.cumsum(counts)
    return flat[np.repeat(offsets[kinds] - (total - counts), counts) + np.arange(total[-1] if len(total) else 0)], total


class Memo:
    """Ids of distinct parts seen lately: two generations of at most ``MEMO_BYTES`` each."""

    def __init__(self, fresh: Callable[[list], list[bytes]]):
        self.fresh = fresh
        self.memo: dict[bytes | str, bytes] = {}
        self.older: dict[bytes | str, bytes] = {}
        self.held = 0

    def look_up(self, parts: list) -> list[bytes]:
        """Ids of each part; new ones are encoded together."""
        out = list(map(self.memo.get, parts))
        lost = [i for i, ids in enumerate(out) if ids is None]
        new = []
        for i in lost:
            out[i] = self.older.get(parts[i])
            if out[i] is None:
                new.append(i)
        for i, ids in zip(new, self.fresh([parts[i] for i in new])):
            out[i] = ids
        for i in lost:
            if len(parts[i]) <= MEMO_CHARS:
                self.memo[parts[i]] = out[i]
                self.held += ENTRY_BYTES + len(parts[i]) + len(out[i])
                if self.held > MEMO_BYTES:
                    self.older, self.memo, self.held = self.memo, {}, 0
        return out


class Encoder:
    """``encode_all(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.bytes_memo = Memo(lambda parts: self._fresh([p.decode("latin-1") for p in parts], single=True))
        self.text_memo = Memo(self._fresh)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        rule, normal = spec["pre_tokenizer"] or {}, spec["normalizer"]
        rules = [p.get("pattern", {}).get("Regex") for p in rule.get("pretokenizers", [])]
        self.words = WORD_RULE in rules and "Lowercase" in str(normal)
        self.known = self.words or (rule.get("type") == "ByteLevel" and rule["use_regex"]
                                    and not rule["add_prefix_space"] and not normal)
        added = spec.get("added_tokens") or [] if added_tokens else []
        self.added = [t["content"] for t in added]
        self.known &= not any(t["normalized"] for t in added)  # those are found in normalised text only
        self.single = Tokenizer.from_file(path)  # for texts that are one normalised pre-token already
        self.single.encode_special_tokens = True
        if self.known:
            self.single.normalizer = normalizers.Sequence([])
            self.single.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def _fresh(self, texts: list[str], single: bool = False) -> list[bytes]:
        found = (self.single if single else self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        ids = [x.ids for x in found]
        raw = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
        ends = [4 * n for n in accumulate(map(len, ids))]
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _latin(self, texts: list[bytes]) -> list[bytes]:
        """Ids of one-byte texts; together at most one block, none empty."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        kind = KIND[data]
        cut = np.empty(len(data), bool)
        cut[1:] = kind[1:] != kind[:-1]
        fresh = np.zeros(len(data), bool)
        fresh[0] = True
        fresh[ends[:-1]] = True
        cut |= fresh
        if self.words:
            cut |= kind == DIGIT
        else:  # the last white character before a word: a blank joins the word, a line feed stands alone
            after = np.flatnonzero(cut & ~fresh & (kind != WHITE) & (np.roll(kind, 1) == WHITE))
            cut[after - 1] = True
            cut[after[data[after - 1] == 32]] = False
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(data))
        if self.words:
            held = kind[first] != WHITE
            first, last = first[held], last[held]
        at, kinds = distinct_tokens(data, first, last)
        raw = data.tobytes()
        ids = self.bytes_memo.look_up([raw[a:b] for a, b in zip(first[at].tolist(), last[at].tolist())])
        tokens, total = gather(ids, kinds)
        bounds = np.append(0, total)[np.searchsorted(first, np.append(0, ends))]
        return [tokens[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]

    def _segments(self, text: str) -> bytes:
        out, at = [], 0
        while at < len(text):
            cut = at + BLOCK_CHARS
            while cut < len(text) and not (text[cut] in " \n" and text[cut - 1] not in " \n"):
                cut += 1
            parts = SEGMENT.findall(text[at:cut])
            kinds = list(dict.fromkeys(parts))
            ids = dict(zip(kinds, self.text_memo.look_up(kinds)))
            out.append(b"".join([ids[p] for p in parts]))
            at = cut
        return b"".join(out)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain: list[tuple[int, bytes]] = []
        for i, text in enumerate(texts):
            if not self.known or any(token in text for token in self.added):
                out[i] = self._fresh([text])[0]
                continue
            try:
                raw = (text.lower() if self.words else text).encode("latin-1")
            except UnicodeEncodeError:
                raw = None
            if raw is not None and 0 < len(raw) <= BLOCK_CHARS and len(raw.translate(None, LEFT_OUT)) == len(raw):
                plain.append((i, raw))
            elif UNUSUAL_SPACE.search(text):
                out[i] = self._fresh([text])[0]
            else:
                out[i] = self._segments(text)
        for a, b in slices([len(raw) for _, raw in plain], BLOCK_CHARS):
            for (i, _), ids in zip(plain[a:b], self._latin([raw for _, raw in plain[a:b]])):
                out[i] = ids
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, added_tokens: bool = False) -> Encoder:
    """One encoder per Python worker, file and treatment of added tokens."""
    if (path, added_tokens) not in _ENCODERS:
        _ENCODERS[path, added_tokens] = Encoder(path, added_tokens)
    return _ENCODERS[path, added_tokens]
