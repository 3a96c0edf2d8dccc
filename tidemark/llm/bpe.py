"""Byte-level BPE encoding and decoding by monoid tree reduction.

An encoding is a monoid element: halves of a text are encoded recursively and
joined by re-encoding a window around the boundary, which grows until the
result outside it provably cannot change. This happens on two levels.

*Atoms.* The pre-tokeniser's pattern never matches across a place where a
non-blank is followed by a blank: every alternative is a run of one class
after at most one space, or a run of blanks. A text is therefore a sequence of
atoms, blanks then non-blanks, that tokenise independently. Joining two halves
re-splits the last atom of the left with the first of the right; a window is
stable once it ends in a whole atom of the right half that has non-blanks.

*Tokens.* Long matches (runs without a blank) are halved too. A token sequence
is the encoding of its bytes if and only if each adjacent pair is what its two
tokens encode to. If re-encoding the window leaves its first and its last token
as they were, all pairs, in the window and across its edges, are such pairs, so
everything outside stands; otherwise the window doubles.

Decoding maps blocks of ids to bytes and concatenates up the tree.

Ranks come from a file given as parameter; each worker reads it once. Encoded
atoms and matches are kept in caches of ``CACHE`` entries, then dropped. The
short words that a batch lacks are merged together, on arrays: in each round,
every unfinished word merges its lowest-ranked, leftmost pair.

Defined cases: a null text counts as empty and has no tokens; equal rows give
equal rows; an empty table gives an empty result; columns besides id and text
are not looked at.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table

# The blanks of the pattern language: Unicode's White_Space property.
BLANK = r"\t-\r \x85\xa0  -     　"
CACHE = 600_000
LEAF_CHARS = 16_384
LEAF_BYTES = 96
BLOCK_IDS = 65_536
NONE = np.int64(1 << 40)
_CODECS: dict[tuple[str, str], Codec] = {}


class Codec:
    """Encoder and decoder for one file of ranks and one pre-tokeniser pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        token = {i: b for b, i in ranks.items()}
        self.sizes = np.array([len(token.get(i, b"")) for i in range(max(token) + 1)], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(token[i] for i in sorted(token)), np.uint8)
        self.packed = {b: i.to_bytes(4, "little") for b, i in ranks.items()}
        explicit = pattern.replace(r"[^\s", f"[^{BLANK}").replace(r"\s", f"[{BLANK}]").replace(r"\S", f"[^{BLANK}]")
        self.pieces = regex.compile(explicit).findall
        self.atoms = regex.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+").findall
        self.other_blank = re.compile("[" + BLANK.replace(r"\t-\r ", r"\t\x0b-\r") + "]").search
        self.blank_end = regex.compile(f"[{BLANK}]\\Z").search
        self.cache: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        made = sorted((ranks[b[:k]] << 32 | ranks[b[k:]], i) for b, i in ranks.items() for k in range(1, len(b)) if b[:k] in ranks and b[k:] in ranks)
        self.pair_keys = np.array([k for k, _ in made] or [-1], np.int64)
        self.pair_values = np.array([i for _, i in made] or [NONE], np.int64)
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.byte_pairs = None
        if self.byte_ids.max() < 256:
            a, b = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
            self.byte_pairs = self.pair_ranks(a.ravel(), b.ravel()).reshape(256, 256)

    @classmethod
    def load(cls, path: str, pattern: str) -> Codec:
        key = (path, pattern)
        if key not in _CODECS:
            with open(path, "rb") as lines:
                _CODECS[key] = cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)
        return _CODECS[key]

    # -- tokens of one match ------------------------------------------------------------

    def merge_bytes(self, word: bytes) -> list[bytes]:
        """The lowest-ranked adjacent pair merges first, the leftmost of equals, until none is left."""
        ranks = self.ranks
        if word in ranks:
            return [word]
        parts = [word[i : i + 1] for i in range(len(word))]
        none = 1 << 60
        pair = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pair:
            low = min(pair)
            if low == none:
                break
            i = pair.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i < len(pair):
                pair[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                pair[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return parts

    def join_tokens(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        if not left or not right:
            return left or right
        w = 1
        while True:
            a, b = min(w, len(left)), min(w, len(right))
            again = self.merge_bytes(b"".join(left[-a:]) + b"".join(right[:b]))
            if (a == len(left) or again[0] == left[-a]) and (b == len(right) or again[-1] == right[b - 1]):
                return left[: len(left) - a] + again + right[b:]
            w *= 2

    def tokens(self, word: bytes) -> list[bytes]:
        """Tokens of one match: leaves are merged directly, then joined pairwise up the tree."""
        if len(word) <= LEAF_BYTES or word in self.ranks:
            return self.merge_bytes(word)
        level = [self.merge_bytes(word[i : i + LEAF_BYTES]) for i in range(0, len(word), LEAF_BYTES)]
        while len(level) > 1:
            level = [self.join_tokens(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0]

    # -- atoms of a text ------------------------------------------------------------------

    def join_atoms(self, left: list[str], right: list[str]) -> list[str]:
        if not left or not right:
            return left or right
        w = 1
        while w < len(right) and self.blank_end(right[w - 1]):
            w += 1
        return left[:-1] + self.atoms(left[-1] + "".join(right[:w])) + right[w:]

    def leaf_atoms(self, text: str) -> list[str]:
        """Where every blank is one space or line break between non-blanks, atoms begin at those; else by pattern."""
        if "\0" in text or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or self.other_blank(text):
            return self.atoms(text)
        return [a for a in text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0") if a]

    def text_atoms(self, text: str) -> list[str]:
        if len(text) <= LEAF_CHARS:
            return self.leaf_atoms(text)
        middle = len(text) // 2
        return self.join_atoms(self.text_atoms(text[:middle]), self.text_atoms(text[middle:]))

    # -- many short matches at once ------------------------------------------------------

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of what each pair of tokens makes, ``NONE`` if it makes none."""
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_values[at], NONE)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word, as ``merge_bytes`` would give them; no word is empty."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        token = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        rank = np.full(len(token), NONE)
        inner = word[:-1] == word[1:]
        rank[:-1][inner] = self.byte_pairs[token[:-1][inner], token[1:][inner]] if self.byte_pairs is not None else self.pair_ranks(token[:-1][inner], token[1:][inner])
        while len(token):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(token)])
            over = least == NONE
            if over.any():
                packed = token.astype("<u4").tobytes()
                for k, n, w in zip((first[over] * 4).tolist(), (size[over] * 4).tolist(), word[first[over]].tolist()):
                    out[w] = packed[k : k + n]
                stay = np.repeat(~over, size)
                word, token, rank = word[stay], token[stay], rank[stay]
                least, size = least[~over], size[~over]
                if not len(token):
                    break
            hits = np.flatnonzero(rank == np.repeat(least, size))
            at = hits[np.r_[True, word[hits[1:]] != word[hits[:-1]]]]
            token[at] = rank[at]
            keep = np.ones(len(token), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep)[at] - 1
            word, token, rank = word[keep], token[keep], rank[keep]
            for near in (moved, moved - 1):
                ends = near < len(token) - 1 if near is moved else near >= 0
                inside = near[ends]
                same = word[inside] == word[np.minimum(inside + 1, len(word) - 1)]
                rank[inside[same]] = self.pair_ranks(token[inside[same]], token[inside[same] + 1])
            last = np.r_[word[1:] != word[:-1], True]
            rank[last] = NONE
        return out

    def learn(self, atoms: set[str]) -> None:
        """Encode ``atoms`` into the cache."""
        packed, cache = self.packed, self.cache
        plain, words, tails, rest = [], [], [], []
        for atom in atoms:
            # The common form, letters and then a few marks, needs no pattern: it is one match, or two.
            head = atom.rstrip(".,;:!?")
            core = head[1:] if head[:1] == " " else head
            if core.isalpha() and len(head) <= 24:
                word = head.encode("utf-8", "surrogatepass")
                whole = packed.get(word)
                tail = atom[len(head) :]
                if whole is not None:
                    cache[atom] = whole + self.piece(tail) if tail else whole
                else:
                    plain.append(atom)
                    words.append(word)
                    tails.append(tail)
            else:
                rest.append(atom)
        for atom, ids, tail in zip(plain, self.merge_many(words), tails):
            cache[atom] = ids + self.piece(tail) if tail else ids
        for atom in rest:
            cache[atom] = b"".join(map(self.piece, self.pieces(atom)))

    def piece(self, match: str) -> bytes:
        """Packed ids of one match."""
        ids = self.known.get(match)
        if ids is None:
            word = match.encode("utf-8", "surrogatepass")
            ids = self.packed.get(word) or b"".join(map(self.packed.__getitem__, self.tokens(word)))
            if len(match) <= 64:
                self.known[match] = ids
        return ids

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        if len(self.known) > CACHE:
            self.known.clear()
        split = [self.text_atoms(t) for t in texts]
        missing = {a for atoms in split for a in atoms if a not in self.cache}
        if missing:
            self.learn(missing)
        get = self.cache.__getitem__
        out = [b"".join(map(get, atoms)) for atoms in split]
        for a in missing:  # one long run must not stay in memory
            if len(a) > 64:
                del self.cache[a]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of packed ids: blocks first, then pairs of results up the tree."""
        level = []
        for i in range(0, len(ids), 4 * BLOCK_IDS):
            block = np.frombuffer(ids[i : i + 4 * BLOCK_IDS], "<u4")
            sizes = self.sizes[block]
            ends = np.cumsum(sizes)
            level.append(self.flat[np.repeat(self.starts[block] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes())
        while len(level) > 1:
            level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


def encode_rows(ranks_path: str, pattern: str, digests: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.load(ranks_path, pattern)
        gc.freeze()
        for batch in batches:
            ids = codec.encode_many([t or "" for t in batch.column(1).to_pylist()])
            out = {"doc_id": batch.column(0), "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64())}
            if digests:
                out["ids_sha256"] = pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string())
                out["decoded_sha256"] = pa.array([hashlib.sha256(codec.decode(i)).hexdigest() for i in ids], pa.string())
            else:
                out["ids"] = pa.array([np.frombuffer(i, "<u4").astype(np.int64) for i in ids], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(out)

    return rows


def _slim(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of long)."""
    return _slim(docs).mapInArrow(encode_rows(ranks_path, pattern, False), "doc_id long, n_tokens long, ids array<long>")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded, and its ids decoded again."""
    return _slim(docs).mapInArrow(encode_rows(ranks_path, pattern, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, text (binary) from doc_id and ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.load(ranks_path, pattern)
        for batch in batches:
            texts = [codec.decode(np.asarray(i or [], "<u4").tobytes()) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(texts, pa.binary())})

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, text binary")


def public_ranks(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Path and pattern of a public tokenizer."""
    import public_tokenizers

    return str(public_tokenizers.path(name)), public_tokenizers.PATTERN


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), *public_ranks())
