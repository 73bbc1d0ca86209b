"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A pair of bytes that occurs inside no token of the vocabulary can never be merged across, so a text may be cut between the two.
Two cuts are used. A whole text is cut at those forced boundaries at which the pre-tokenizer starts a piece whatever stands
around them, such as the end of a word. Fragments are encoded independently, the short ones once for
each cache, and concatenated. A long fragment is pre-tokenized, and every piece is cut at all its forced boundaries before its
merges, so that the work on a run without blanks stays in proportion to its length.
"""

from __future__ import annotations

import hashlib
import json
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, trimmed
from .textvec import row_slices, utf8

#: Fixed by the byte-level format: bytes that stand for themselves; the others follow as code points from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Bounds of the cache of encoded fragments in each task.
CACHE_ENTRIES = 200_000
CACHE_BYTES = 48
#: Text encoded before its rows are handed on.
BATCH_BYTES = 1 << 20


def byte_chars() -> list[str]:
    """The character that stands for each byte in the vocabulary."""
    plain = set(_PLAIN)
    chars, rest = [], 256
    for b in range(256):
        chars.append(chr(b if b in plain else rest))
        rest += b not in plain
    return chars


ALWAYS, AFTER_LETTER, AFTER_BREAK = 1, 2, 3
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _cut_rules() -> np.ndarray:
    """By the two bytes at a place: whether the pre-tokenizer always starts a piece there. Its pieces are runs of letters, of digits
    or of other signs, each with one blank before it, and runs of white space, whose last blank or character stands apart when
    more follows. A place after a byte of a longer character or after white space needs a look at the bytes before."""
    b = np.arange(256)
    letter, digit = (b >= 65) & (b <= 90) | (b >= 97) & (b <= 122), (b >= 48) & (b <= 57)
    sign = (b < 128) & ~letter & ~digit & ~_SPACE
    kind = np.select([letter, digit, sign, _SPACE], [1, 2, 3, 4], 0)
    rules = np.where((kind[:, None] != kind) & (kind[:, None] > 0) & (kind[:, None] < 4) & (kind > 0), ALWAYS, 0)
    rules[128:192, (kind == 3) | (kind == 4)] = AFTER_LETTER
    breaks = _SPACE & (b != 32)
    rules[np.ix_(breaks, (kind >= 1) & (kind <= 3) | (b == 0xC3))] = AFTER_BREAK
    return rules.astype(np.uint8)


class ForcedBpe:
    """Encoder and decoder built from the text of a tokenizer file."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.model, self.pre = self.tokenizer.model, self.tokenizer.pre_tokenizer
        parsed = json.loads(spec)
        if parsed["model"]["type"] != "BPE" or parsed["normalizer"] or parsed["pre_tokenizer"]["type"] != "ByteLevel" or parsed["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a byte-level BPE without normalizer and prefix blank is needed")
        to_byte = {c: b for b, c in enumerate(byte_chars())}
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in parsed["added_tokens"]):
            raise ValueError("added tokens that strip or need whole words aren't supported")
        vocab = parsed["model"]["vocab"]
        tokens = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for text, i in vocab.items():
            tokens[i] = bytes(to_byte[c] for c in text)
        self.forced = np.ones((256, 256), dtype=bool)
        for t in tokens:
            a = np.frombuffer(t, dtype=np.uint8)
            self.forced[a[:-1], a[1:]] = False
        for text, i in self.special.items():
            tokens[i] = text.encode()
        self.lens = np.array([len(t) for t in tokens])
        self.starts = np.concatenate(([0], np.cumsum(self.lens)))[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.rule = _cut_rules() * self.forced
        self.cache: dict[bytes, bytes] = {}

    def _piece(self, chars: str) -> list[int]:
        """Ids of a pre-token, given as characters that stand for its bytes; cut at its forced boundaries first."""
        if len(chars) < 3:
            return [t.id for t in self.model.tokenize(chars)]
        raw = np.frombuffer(chars.translate(_TO_BYTE).encode("latin-1"), dtype=np.uint8)
        cuts = np.flatnonzero(self.forced[raw[:-1], raw[1:]]) + 1
        ids, at = [], 0
        for cut in [*cuts.tolist(), len(chars)]:
            ids += [t.id for t in self.model.tokenize(chars[at:cut])]
            at = cut
        return ids

    def _fragment(self, raw: bytes) -> bytes:
        text = raw.decode("utf-8", "replace")
        word = text[1:] if text[:1] == " " else text
        if len(raw) > CACHE_BYTES:
            ids = [i for chars, _ in self.pre.pre_tokenize_str(text) for i in self._piece(chars)]
        elif word.isalpha() and max(word) < "\u0250":  # one pre-token
            ids = [t.id for t in self.model.tokenize(raw.decode("latin-1").translate(_TO_CHAR))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        made = struct.pack(_U32[len(ids)], *ids) if len(ids) < len(_U32) else np.array(ids, dtype="<u4").tobytes()
        if len(raw) <= CACHE_BYTES:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[raw] = made
        return made

    def _cuts(self, raw: np.ndarray) -> list[int]:
        """Where a text is cut: forced boundaries at which the pre-tokenizer starts a piece whatever else the text holds."""
        rule = self.rule[raw[:-1], raw[1:]]
        cut = rule == ALWAYS
        letter = lambda i: (raw[i - 1] == 0xC3) & (i > 0) & (raw[i] >= 0x80) & (raw[i] != 0x97) & (raw[i] != 0xB7)  # noqa: E731  U+00C0 to U+00FF but the two signs
        at = np.flatnonzero(rule == AFTER_LETTER)
        cut[at] = letter(at)
        at = np.flatnonzero(rule == AFTER_BREAK)
        before = np.maximum(at - 1, 0)
        cut[at] = (at == 0) | ~_SPACE[raw[before]] & (raw[before] < 0x80) | letter(before)
        return (np.flatnonzero(cut) + 1).tolist()

    def _plain(self, text: bytes) -> bytes:
        """Ids of a text without added tokens."""
        if not text:
            return b""
        get, out, at = self.cache.get, [], 0
        for cut in [*self._cuts(np.frombuffer(text, dtype=np.uint8)), len(text)]:
            part = text[at:cut]
            out.append(get(part) or self._fragment(part))
            at = cut
        return b"".join(out)

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers. An added token's own text gives that token."""
        parts = [text]
        for special, i in self.special.items():
            own = np.array([i], dtype="<u4").tobytes()
            parts = [y for x in parts for y in _between(x, special.encode(), own)]
        return b"".join(x.ids if isinstance(x, _Ids) else self._plain(x) for x in parts)

    def decode(self, ids: bytes) -> bytes:
        """The text of ids in UTF-8; bytes that are none become replacement characters."""
        i = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        out = []
        for at in range(0, len(i), 1 << 18):
            part = i[at:at + (1 << 18)]
            lens = self.lens[part]
            upto = np.cumsum(lens)
            out.append(self.bytes[np.arange(int(upto[-1])) + np.repeat(self.starts[part] - (upto - lens), lens)].tobytes())
        raw = b"".join(out)
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()
        return raw


class _Ids:
    def __init__(self, ids: bytes):
        self.ids = ids


def _between(part, special: bytes, own: bytes) -> list:
    if isinstance(part, _Ids) or special not in part:
        return [part]
    out: list = []
    for x in part.split(special):
        out += [x, _Ids(own)]
    return out[:-1]


_U32 = [f"<{n}I" for n in range(64)]
_TO_CHAR = {b: c for b, c in enumerate(byte_chars())}
_TO_BYTE = {ord(c): b for b, c in enumerate(byte_chars())}


def _encoded(spec: str, with_ids: bool, with_text: bool):
    """Kernel: batches of (id, text) to batches of the columns of ``encode_texts``, each of about BATCH_BYTES of text."""

    def run(batches):
        bpe = ForcedBpe(spec)
        give_back()  # what the vocabulary took while it was read
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in row_slices(offsets, BATCH_BYTES):
                n, ids_sha, text_sha, ids, texts = [], [], [], [], []
                for a, b in zip(offsets[i:j].tolist(), offsets[i + 1:j + 1].tolist()):
                    got = bpe.encode(data[a:b].tobytes())
                    back = bpe.decode(got)
                    n.append(len(got) // 4)
                    ids_sha.append(hashlib.sha256(got).hexdigest())
                    text_sha.append(hashlib.sha256(back).hexdigest())
                    if with_ids:
                        ids.append(got)
                    if with_text:
                        texts.append(back.decode())
                cols = {"doc_id": batch.column(0).slice(i, j - i), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
                if with_ids:
                    all_ids = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int64)
                    cols["ids"] = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(n))).astype(np.int32), pa.array(all_ids))
                if with_text:
                    cols["decoded"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_pydict(cols)

    return run


def encode_texts(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """One row per row: doc_id, n_tokens, ids_sha256, decoded_sha256; optionally ids (array) and decoded (string).

    ``spec`` is the text of the tokenizer file. Null and empty texts have no tokens; other columns are not read."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * with_ids + ", decoded string" * with_text
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(trimmed(_encoded(spec, with_ids, with_text)), schema)


def read_spec(path: str) -> str:
    """The tokenizer file's text, read once on the driver and sent to the tasks with the code (some MB, whatever the corpus)."""
    with open(path, encoding="utf-8") as f:
        return f.read()
