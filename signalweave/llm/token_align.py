"""Alignment of two tokenizers' tokens over the bytes of each text, and corpus-wide counts of the linked id pairs.

Tokens of A and B that overlap in bytes are the edges of a bipartite graph; its components, found by union-find, are exactly the
minimal groups between offsets where both tokenizers end a token. Members of a component whose byte ranges end together are linked.
Pairs of linked ids are counted over the whole corpus, and each text is told how its links rank in it.

Where both tokenizers cut a text at each single space between other characters, texts are aligned by such segments, and each distinct
segment of a few megabytes of text once. One of two linked tokens is a suffix of the other, so the vocabularies bound the number of pairs.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lean, read_table, text_or_empty, trim
from .spm import SPACE, batches_of, parse_model

MODEL_A, MODEL_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of texts handled together, and threads of a worker.
COLUMN_CHARS, THREADS = 1_500_000, 2
#: Segments that are encoded in one call.
JOINED = 64
#: A space next to another white space character (or at an end) is no cut; such texts are cut with a pattern that looks around.
_ODD = r"^\s|\s$| [\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
_CUT = re.compile(r"(?<=\S) (?=\S)")


@functools.cache
def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable Latin-1 for itself, the others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def bytes_of_a(raw: bytes) -> list[bytes | None]:
    """By id, the bytes of a byte-level BPE file's entries; none for special tokens and unused ids."""
    spec = json.loads(raw)
    special = {t["id"] for t in spec.get("added_tokens", [])}
    letters, vocab = byte_letters(), spec["model"]["vocab"]
    out: list[bytes | None] = [None] * (max(vocab.values(), default=-1) + 1)
    for token, i in vocab.items():
        if i not in special and all(c in letters for c in token):
            out[i] = bytes(letters[c] for c in token)
    return out


def bytes_of_b(raw: bytes) -> list[bytes | None]:
    """By id, the bytes of a SentencePiece model's pieces: the marker as a space, byte pieces as their byte; none for control and unknown ones."""
    byte_piece = re.compile(r"<0x([0-9A-F]{2})>")
    out: list[bytes | None] = []
    for piece, _, kind in parse_model(raw).pieces:
        m = byte_piece.fullmatch(piece)
        out.append(None if kind in (2, 3) else bytes([int(m[1], 16)]) if kind == 6 and m else piece.replace(SPACE, " ").encode())
    return out


def possible_pairs(a: list[bytes | None], b: list[bytes | None]) -> np.ndarray:
    """Sorted codes (id of A times the size of B plus id of B) of all pairs where one token's bytes end in the other's.

    No other tokens can end together, so these are all pairs that can be linked; they are at most as many as the bytes of both vocabularies.
    """

    def suffixes(long: list[bytes | None], short: list[bytes | None]) -> Iterator[tuple[int, int]]:
        where: dict[bytes, list[int]] = {}
        for i, t in enumerate(short):
            if t:
                where.setdefault(t, []).append(i)
        for i, t in enumerate(long):
            for k in range(len(t or b"")):
                for j in where.get(t[k:], ()):
                    yield i, j

    size = len(b)
    found = {i * size + j for i, j in suffixes(a, b)} | {i * size + j for j, i in suffixes(b, a)}
    return np.array(sorted(found), np.int64)


def components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Union-find over the edges (u, v) of ``n`` nodes, all edges at once: by node, the smallest node of its component.

    Roots of each edge's ends are united, the larger under the smaller, and paths are compressed, until no edge joins two roots.
    """
    parent = np.arange(n)
    while len(u):
        pu, pv = parent[u], parent[v]
        apart = pu != pv
        u, v = u[apart], v[apart]
        np.minimum.at(parent, np.maximum(pu, pv)[apart], np.minimum(pu, pv)[apart])
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The component number of each A token and of each B token, in text order; tokens that overlap are in one component.

    Both arrays hold the end offsets of tokens that cover the same bytes without gaps. An overlap is an edge; A token i overlaps the B
    tokens from the first that ends behind its start to the first that does not end before its end, so edges are fewer than tokens.
    """
    first = np.searchsorted(b_ends, np.append(0, a_ends)[: len(a_ends)], "right")
    count = np.searchsorted(b_ends, a_ends, "left") + 1 - first
    u = np.repeat(np.arange(len(a_ends)), count)
    v = np.arange(len(u)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    parent = components(len(a_ends) + len(b_ends), u, v + len(a_ends))
    number = np.cumsum(parent == np.arange(len(parent))) - 1
    return number[parent[: len(a_ends)]], number[parent[len(a_ends) :]]


def links_of(a_ends: np.ndarray, b_ends: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (of A, of B) of the members of one component whose byte ranges end together."""
    at = np.minimum(np.searchsorted(b_ends, a_ends), len(b_ends) - 1)
    i = np.flatnonzero((b_ends[at] == a_ends) & (b_group[at] == a_group))
    return i, at[i]


@dataclass
class Aligned:
    """Alignments of some texts, as columns: counts, the groups' text, and the pairs of the links (places in ``possible_pairs``) with their bounds."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    shown: pa.Array
    pairs: np.ndarray
    ends: np.ndarray


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(sizes))


def _gather(flat: np.ndarray, bounds: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the pieces ``index`` of ``flat`` behind each other, their sizes)."""
    sizes = np.diff(bounds)[index]
    before = np.cumsum(sizes) - sizes
    return flat[np.arange(int(sizes.sum())) + np.repeat(bounds[:-1][index] - before, sizes)], sizes


class Aligner:
    """Encodes texts with both tokenizers and aligns their tokens. Special tokens inside texts are plain text to both."""

    def __init__(self, raw_a: bytes, raw_b: bytes, pairs: np.ndarray | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        self.a = Tokenizer.from_str(raw_a.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=raw_b)
        bytes_a, bytes_b = bytes_of_a(raw_a), bytes_of_b(raw_b)
        self.vocab_a, self.vocab_b = (pa.array([x or b"" for x in t], pa.large_binary()) for t in (bytes_a, bytes_b))
        self.size_a, self.size_b = (np.array([len(x or b"") for x in t], np.int64) for t in (bytes_a, bytes_b))
        self.pairs = possible_pairs(bytes_a, bytes_b) if pairs is None else pairs
        # An id with the sign behind it: within or at the end of A's part of a group, within or at the end of B's.
        self.written = pa.array([f"{i}{x}" for t, signs in ((bytes_a, ",|"), (bytes_b, ",;")) for i in range(len(t)) for x in signs], pa.large_string())
        spec, model = json.loads(raw_a), parse_model(raw_b)
        pre = spec.get("pre_tokenizer") or {}
        # Segments can be aligned apart if A's pattern starts a word at each such space and no piece of B has the marker after another character.
        splits_a = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        splits_b = model.dummy_prefix and model.escape and not (model.suffix_space or model.charsmap or model.collapse) and not any(SPACE in p.lstrip(SPACE) for p, _, t in model.pieces if t in (1, 4))
        self.by_segment = bool(splits_a and splits_b)

    def _ids(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: (ids of all texts, number of each text's)."""
        a, b = [], []
        for some in batches_of(texts):
            a += [e.ids for e in self.a.encode_batch_fast([" " + t for t in some], add_special_tokens=False)]
            b += self.b.encode(some, num_threads=THREADS)
        for lists in (a, b):
            sizes = np.array([len(x) for x in lists], np.int64)
            yield np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes

    @staticmethod
    def _ends(want: list[bytes], ids: np.ndarray, vocab: pa.Array, lengths: np.ndarray) -> np.ndarray | None:
        """Where the tokens' bytes are those of ``want``, and tokens end wherever one of these does: how many tokens each has, else none."""
        got = vocab.take(pa.array(ids)).buffers()[2].to_pybytes() if len(ids) else b""
        bounds, ends = _starts(np.array([len(w) for w in want], np.int64)), _starts(lengths[ids])
        at = np.searchsorted(ends, bounds)
        return np.diff(at) if got == b"".join(want) and np.array_equal(ends[np.minimum(at, len(ends) - 1)], bounds) else None

    def _encoded(self, texts: list[str], joined: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A, numbers of them, ids of B, numbers) of ``texts``, ``joined`` of them together with spaces between.

        A text whose bytes do not come back has none. Where that happens, or a token goes over an end, texts are halved until they are alone.
        """
        (a, _), (b, _) = self._ids([" ".join(texts[i : i + joined]) for i in range(0, len(texts), joined)])
        want = [(" " + t).encode() for t in texts]
        na, nb = self._ends(want, a, self.vocab_a, self.size_a), self._ends(want, b, self.vocab_b, self.size_b)
        if na is not None and nb is not None:
            return a, na, b, nb
        if len(texts) == 1:
            return a[:0], np.zeros(1, np.int64), b[:0], np.zeros(1, np.int64)
        half = len(texts) // 2
        parts = self._encoded(texts[:half], joined), self._encoded(texts[half:], joined)
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def align(self, texts: list[str], joined: int = 1) -> Aligned:
        """Alignments of ``texts``. With ``joined``, so many are encoded together: segments without white space at their ends only."""
        a, na, b, nb = self._encoded(texts, joined)
        # One line of bytes for all texts: each ends a token of both, so no component goes over it.
        a_ends, b_ends = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ga, gb = groups_of(a_ends, b_ends)
        i, j = links_of(a_ends, b_ends, ga, gb)
        last = lambda g: np.append(g[1:] != g[:-1], True)[: len(g)]
        group_a = np.bincount(ga)
        group_b = np.bincount(gb)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + _starts(group_b)[ga]] = 2 * a + last(ga)
        order[np.arange(len(b)) + _starts(group_a)[gb + 1]] = 2 * len(self.size_a) + 2 * b + last(gb)
        pieces = self.written.take(pa.array(order))
        offsets = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1) if len(pieces) else np.zeros(1, np.int64)
        bounds = offsets[_starts(na + nb)].astype(np.int64)
        shown = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(bounds), pieces.buffers()[2] if len(pieces) else pa.py_buffer(b""))
        of_text = _starts(na)
        n_links = np.diff(np.searchsorted(i, of_text))
        n_groups = np.diff(np.append(ga, len(group_a))[of_text]) if len(a) else np.zeros(len(texts), np.int64)
        return Aligned(na, nb, n_groups, shown, np.searchsorted(self.pairs, a[i] * len(self.size_b) + b[j]).astype(np.int32), _starts(n_links))

    def _texts(self, lists: pa.Array, joined: int = 1) -> Aligned:
        """Alignments of texts given as lists of segments; each distinct segment is aligned once."""
        coded = lists.flatten().dictionary_encode()
        found = self.align(coded.dictionary.to_pylist(), joined)
        index, ends = coded.indices.to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        per_text = lambda x: np.diff(_starts(x[index])[ends])
        good = per_text((found.n_a == 0).astype(np.int64)) == 0
        sizes = np.diff(ends)
        index, ends = index[np.repeat(good, sizes)], _starts(sizes * good)
        shown = found.shown.take(pa.array(index))
        offsets = np.frombuffer(shown.buffers()[1], np.int64, len(shown) + 1) if len(shown) else np.zeros(1, np.int64)
        texts = pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(offsets[ends].astype(np.int64)), shown.buffers()[2] if len(shown) else pa.py_buffer(b""))
        pairs, each = _gather(found.pairs, found.ends, index)
        return Aligned(per_text(found.n_a), per_text(found.n_b), per_text(found.n_groups), texts, pairs, _starts(each)[ends])

    def column(self, texts: pa.Array) -> Aligned:
        """Alignments of a string column without nulls; empty texts have no tokens."""
        odd = np.ones(len(texts), bool)
        if self.by_segment and len(texts):
            odd = pc.or_(pc.match_substring_regex(texts, _ODD), pc.equal(texts, "")).to_numpy(zero_copy_only=False)
        rest = texts.filter(pa.array(odd)).to_pylist()
        cut = [[] if t == "" else _CUT.split(t) if self.by_segment else [t] for t in rest]
        both = [self._texts(pc.split_pattern(texts.filter(pa.array(~odd)), " "), JOINED), self._texts(pa.array(cut, pa.list_(pa.string())))]
        place = np.argsort(np.append(np.flatnonzero(~odd), np.flatnonzero(odd)))
        every = lambda name: np.concatenate([getattr(x, name) for x in both])[place]
        sizes = np.concatenate([np.diff(x.ends) for x in both])
        pairs, each = _gather(np.concatenate([x.pairs for x in both]), _starts(sizes), place)
        return Aligned(every("n_a"), every("n_b"), every("n_groups"), pa.concat_arrays([x.shown for x in both]).take(pa.array(place)), pairs, _starts(each))


_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>"
_SHOWN = ", groups string"


def _aligned(raw_a: bytes, raw_b: bytes, possible: np.ndarray, keep_groups: bool):
    fields = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int32()))]
    schema = pa.schema(fields + [("groups", pa.string())] * keep_groups)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(raw_a, raw_b, possible)
        for batch in batches:
            total = np.cumsum(pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = [0, *(np.flatnonzero(np.diff(total // COLUMN_CHARS)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                x = aligner.column(batch.column(1).slice(lo, hi - lo))
                # Each group ends with a semicolon; that of the last one does not belong to the text.
                groups = pc.utf8_rtrim(x.shown, ";")
                digests = [hashlib.sha256(t.as_buffer()).hexdigest() if n else "" for t, n in zip(groups, x.n_a.tolist(), strict=True)]
                counts = [pa.array(n) for n in (x.n_a, x.n_b, x.n_groups, np.diff(x.ends))]
                pairs = pa.ListArray.from_arrays(pa.array(x.ends.astype(np.int32)), pa.array(x.pairs))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *counts, pa.array(digests), pairs, *([groups.cast(pa.string())] if keep_groups else [])], schema=schema)
            trim()

    return run


def align_tokens(docs: DataFrame, path_a: str = MODEL_A, path_b: str = MODEL_B, keep_groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs (the links' places in ``possible_pairs``), and the groups
    as text if asked for.

    A encodes a space and the text, B the text, to which it adds the space. Null and empty texts, and those whose tokens' bytes differ
    from a space and the text, have no tokens: zeros, an empty digest and no pairs. Other columns are not read, a null id stays null, an
    empty table stays empty, and repeated rows have equal results. No shuffle: texts are aligned where they are read.
    """
    raw_a, raw_b = _read(path_a), _read(path_b)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(lean(_aligned(raw_a, raw_b, possible_pairs(bytes_of_a(raw_a), bytes_of_b(raw_b)), keep_groups)), _DDL + _SHOWN * keep_groups)


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many links of the corpus hold each id pair; summed in each task before the shuffle."""
    return aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


def _ranked(counts: np.ndarray, best: np.ndarray, names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = batch.column("pairs")
            at, ends = pairs.flatten().to_numpy(), pairs.offsets.to_numpy() - pairs.offsets[0].as_py()
            total = lambda x: np.diff(_starts(x[at])[ends])
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(total(best)), pa.array(total(counts))], names=[*names, "n_best", "count_sum"])

    return run


def rank_links(aligned: DataFrame, path_a: str = MODEL_A, path_b: str = MODEL_B) -> DataFrame:
    """``aligned`` without its pairs, with n_best and count_sum.

    ``aligned`` is read twice and should be a written table. Counts of pairs reach the driver and all tasks: they are at most as many as
    ``possible_pairs``, which depends on the vocabularies alone (some hundred thousand for the given ones), however large the corpus is.
    """
    b = bytes_of_b(_read(path_b))
    id_b = possible_pairs(bytes_of_a(_read(path_a)), b) % len(b)
    table = pair_counts(aligned).toArrow()
    counts = np.zeros(len(id_b), np.int64)
    counts[table.column("pair").to_numpy()] = table.column("n").to_numpy()
    highest = np.zeros(len(b), np.int64)
    np.maximum.at(highest, id_b, counts)
    names = [c for c in aligned.columns if c != "pairs"]
    ddl = ", ".join(f"{n} {t}" for n, t in aligned.drop("pairs").dtypes) + ", n_best long, count_sum long"
    return aligned.mapInArrow(lean(_ranked(counts, (counts == highest[id_b]).astype(np.int64), names)), ddl)


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Per document its numbers of tokens, groups and links, the digest of its groups, and how its links rank in the corpus."""
    aligned = Scratch(spark).stored(align_tokens(read_table(spark, sf_dir, "documents")), "aligned")
    return rank_links(aligned).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
