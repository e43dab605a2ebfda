"""BPE encoding and decoding by forced boundaries.

A pair of neighbouring bytes that no vocabulary token contains can never end
up inside one token, so every such pair is a certain cut.  Of these, the cuts
at an ASCII white-space byte that follows an ink character are also cuts of
the vocabulary's own pre-splitting, which looks ahead over white space only.
The text is cut there, each distinct fragment is encoded once, and the results
are concatenated.  Fragments of ASCII and Latin letters go to ``tiktoken``, one
behind the other, with ranks taken from the same file; all others, and those
with an added token, go one by one to ``tokenizers``.

Nulls count as empty texts, and an empty text has no tokens and decodes to
an empty text.  Repeated rows are encoded alike.  Columns of the input with
the names of the output columns are replaced, and all others pass through.
"""

from __future__ import annotations

import functools
import itertools
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.llm.common import add_columns, table, text_buffer

#: Fragments that a task keeps encoded; beyond it the memo starts anew.
MEMO = 600_000
GAPS = " \t\n\x0b\x0c\r"
# Fixed value: the public pre-splitting pattern of byte-level vocabularies.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def joined_pairs(vocab: list[str], special: set[str]) -> np.ndarray:
    """256 x 256: is there a token that holds byte a followed by byte b?"""
    of = byte_alphabet()
    inside = np.zeros((256, 256), dtype=bool)
    for token in vocab:
        if token not in special:
            b = [of[c] for c in token]
            inside[b[:-1], b[1:]] = True
    return inside


class Fragments:
    """Forced boundaries and a memo of encoded fragments, for one task."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, of = spec["model"]["vocab"], byte_alphabet()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pre = spec["pre_tokenizer"] or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("the vocabulary is not a plain byte-level one")
        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        cut = ~joined_pairs(list(vocab), set(added))
        gaps = np.zeros(256, dtype=bool)
        gaps[[0x20, *range(0x09, 0x0E)]] = True
        if any(c.isspace() for t in added for c in t) or any(t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            gaps[:] = False  # an added token could span a cut: encode whole texts
        self.cut = cut & gaps[None, :]
        ranks = {bytes(of[c] for c in t): i for t, i in vocab.items() if t not in added}
        pieces = [None] * (max([*vocab.values(), *added.values()]) + 1)
        for t, i in ranks.items():
            pieces[i] = t
        for t, i in added.items():
            pieces[i] = t.encode()
        self.pieces = pa.array(pieces, pa.large_binary())  # bytes of each token, by id
        self.size = np.array([len(t or b"") for t in pieces], np.int64)
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in spec["model"]["merges"]]
        orderly = all(vocab[a] < vocab[b] for a, b in zip(merges, merges[1:], strict=False))  # ids follow the order of merges
        #: Bytes after which any gap is a forced boundary: what ends in one may stand before another fragment in one call.
        self.last = cut[:, gaps].all(axis=1) if gaps.any() and orderly else np.zeros(256, dtype=bool)
        self.quick = tiktoken.Encoding("fragments", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}) if orderly else None
        self.hard = re.compile("|".join([*map(re.escape, added), r"[^\x09-\x0D\x20-\x7E\u00C0-\u00FF]"]))
        self.forget()

    def forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.known = [np.zeros(0, np.int32)]
        self.ends = [np.zeros(1, np.int64)]

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Places in ``data`` where a fragment starts by a forced boundary."""
        if len(data) < 2:
            return np.zeros(0, np.int64)
        ink = (data >= 0x21) & (data <= 0x7E)
        ink[1:] |= (data[1:] >= 0x80) & (data[:-1] == 0xC3)  # U+00C0 to U+00FF: no white space among them
        return np.flatnonzero(ink[:-1] & self.cut[data[:-1], data[1:]]) + 1

    def encoded(self, fragments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the fragments, one behind the other, and where each starts."""
        texts = [f.decode() for f in fragments]
        chained, alone = [], []
        for i, t in enumerate(texts):
            easy = t[0] in GAPS and t[-1] not in GAPS and self.last[fragments[i][-1]] and not self.hard.search(t)
            (chained if easy else alone).append(i)
        count, parts = np.zeros(len(texts), np.int64), []
        for at in range(0, len(chained), 20_000):
            some = chained[at : at + 20_000]
            ids = np.array(self.quick.encode_ordinary("".join([texts[i] for i in some])), np.int32)
            ends = np.cumsum([len(fragments[i]) for i in some])
            to = np.searchsorted(np.cumsum(self.size[ids]), ends) + 1  # no token crosses a cut
            count[some] = np.diff(to, prepend=0)
            parts.append(ids)
        rest = [e.ids for e in self.tok.encode_batch([texts[i] for i in alone], add_special_tokens=False)]
        count[alone] = [len(r) for r in rest]
        flat = np.concatenate([*parts, np.fromiter(itertools.chain.from_iterable(rest), np.int32)])
        order = np.array([*chained, *alone], np.int64)  # flat has them in this order
        ends = np.cumsum(count[order])
        start = np.empty(len(texts), np.int64)
        start[order] = ends - count[order]
        ends = np.cumsum(count)
        where = np.repeat(start - (ends - count), count) + np.arange(len(flat))
        return flat[where], ends

    def __call__(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        data, off = text_buffer(texts)
        starts = np.sort(np.concatenate([self.cuts(data), off[:-1][off[:-1] < off[1:]]]))  # a cut may be the start of a text
        starts = starts[np.diff(starts, prepend=-1) > 0]
        bounds = np.append(starts, len(data)).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.memo) + len(distinct) > MEMO:
            self.forget()
        new = [f for f in distinct if f not in self.memo]
        if new:
            flat, ends = self.encoded(new)
            self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new)), strict=True))
            self.ends.append(ends + self.ends[-1][-1])
            self.known.append(flat)
        self.known, self.ends = [np.concatenate(self.known)], [np.concatenate(self.ends)]
        which = np.array([self.memo[f] for f in distinct], np.int64)[coded.indices.to_numpy()]
        low = self.ends[0][which]
        count = self.ends[0][which + 1] - low
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.known[0][np.repeat(low - total[:-1], count) + np.arange(total[-1])]
        first = total[np.searchsorted(starts, off)]  # first token of each text
        tokens = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))
        return tokens, self.decode(ids, first)

    def decode(self, ids: np.ndarray, first: np.ndarray) -> pa.Array:
        """Texts of runs of ids: the tokens' bytes, as UTF-8 with replacement of what is none."""
        chars = self.pieces.take(pa.array(ids, pa.int64()))
        place = np.concatenate([[0], np.cumsum(self.size[ids])])[first]
        said = pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer(place.astype(np.int64)), chars.buffers()[2] or pa.py_buffer(b"")])
        try:
            return said.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in said.to_pylist()], pa.string())


def encode_decode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Append the token ids (array of int) of ``text`` and the text they decode to.

    ``vocabulary`` is the place of a byte-level BPE file that every executor can read.
    """

    def make():
        fragments = Fragments(vocabulary)
        return lambda batch: fragments(batch.column(text))

    return add_columns(df, f"`{ids}` array<int>, `{decoded}` string", text, make)


@functools.cache
def public_vocabulary() -> str:
    """Place of the 50k byte-level vocabulary that this box offers."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def digests(encoded: DataFrame, *keep: str) -> DataFrame:
    """Token count and SHA-256 digests of what :func:`encode_decode` appended."""
    return encoded.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return digests(encode_decode(docs, public_vocabulary()), "doc_id")
