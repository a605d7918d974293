"""Cross-tokenizer alignment with an identity-map fast path (operator 12).

A text with a leading space is encoded by a byte-level vocabulary (A) and by a
sentence-piece vocabulary (B, which adds the space).  Byte offsets where tokens
of both end cut the text into groups; within a group every A token is linked
with every B token.  The count of an id pair is the number of documents that
hold it linked.

Most groups are one A token beside the B token of the same bytes.  ``identity``
maps each A id to that B id, worked out once from the vocabularies; documents
that hold such a pair are counted in one vector with a place per A id.  Only
the other pairs enter a shuffle: tasks add them up first, the pairs are summed
by key, and each document then looks its pairs up: identity pairs in the
vector, the most frequent others in a table of at most ``hot_pairs`` rows, the
rest by a join (no key of which holds more than the least hot pair's rows).

Texts are cut where white space follows other characters, at places no token
of either vocabulary and no match of A's pattern goes over; pieces between are
aligned once and remembered.

Defined cases: a text that is null or empty, or whose joined token bytes
differ from space + text, has no tokens: zeros and an empty digest column; a
document counts a pair once however often it holds it; repeated rows count and
are returned once each; null ids are kept; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections import Counter
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.byte_bpe import WHITE, byte_characters
from flowlens.llm.common import batch, portions, prepare, written

HOT_PAIRS = 65_536
PART = 512  # short pieces encoded as one text
FLUSH = 1 << 20  # irregular pairs a task holds before it adds them up

DOC, VECTOR, PAIRS = 0, 1, 2
_ROW = pa.schema([("kind", pa.int32()), ("rid", pa.int64()), ("doc_id", pa.int64()),
                  ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                  ("ids", pa.list_(pa.int32())), ("id_n", pa.list_(pa.int64())),
                  ("pairs", pa.list_(pa.int64())), ("pair_n", pa.list_(pa.int64()))])
_ROW_DDL = ("kind int, rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
            "groups_sha256 string, ids array<int>, id_n array<long>, pairs array<long>, "
            "pair_n array<long>")


class Vocabularies:
    """Both tokenizers and the bytes of their ids.  A pair of ids is one long,
    A id << 32 | B id."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        back = {c: i for i, c in enumerate(byte_characters())}
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [_spelled(self.a.id_to_token(i) or "", back) for i in range(size)]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        # normal pieces stand for their bytes before single-byte ids do
        same: dict[bytes, int] = {}
        for i in sorted(range(len(self.b_bytes)), key=lambda i: (self.b.is_byte(i), i)):
            if not (self.b.is_control(i) or self.b.is_unknown(i)):
                same.setdefault(self.b_bytes[i], i)
        self.identity = np.array([same.get(t, -1) for t in self.a_bytes], np.int64)
        # white space that some piece holds after another character is no place to cut
        pieces = [t.decode("utf-8", "replace") for t in self.b_bytes]
        white = re.compile(f"(?<=[^{WHITE}])[{WHITE}]")
        unsafe = set(chain.from_iterable(white.findall(p) for p in pieces))
        loose = "".join(f"\\u{ord(c):04x}" for c in sorted(unsafe))
        run = f"[{WHITE}]*[^{WHITE}]+"
        more = f"(?:[{loose}][{WHITE}]*[^{WHITE}]*)*" if unsafe else ""
        self.cut = re.compile(f"{run}{more}|[{WHITE}]+").findall
        self.white = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{WHITE}]", c))
        self.lead = len(self.b.encode("a"))
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        # each id as it stands in the digest text: not last and last of its group
        self.spelled = [f"{i}{end}" for end in (",", "|") for i in range(size)] + [
            f"{i}{end}" for end in (",", ";") for i in range(len(self.b_bytes))]
        self.known: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def aligned(self, pieces: set[str], limit: int = 150_000, longest: int = 64) -> dict[str, tuple]:
        """What ``align`` finds for each piece, None where the bytes differ;
        short ones are remembered in two generations."""
        if len(self.known) > limit:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        missing = pieces.difference(known)
        back = missing.intersection(old)
        known.update(zip(back, map(old.__getitem__, back)))
        missing -= back
        there = pieces - missing
        found = dict(zip(there, map(known.__getitem__, there)))
        other = [p for p in missing if len(p) > longest or p[-1] in self.white]
        plain = list(missing.difference(other))
        parts = [plain[i:i + PART] for i in range(0, len(plain), PART)]
        while parts:
            part = parts.pop()
            entries = self.align_joined(part)
            if entries is None and len(part) > 8:  # some piece does not fit: look for it in halves
                parts += [part[:len(part) // 2], part[len(part) // 2:]]
            elif entries is None:
                other += part
            else:
                known.update(zip(part, entries, strict=True))
                found.update(zip(part, entries, strict=True))
        for p in other:
            found[p] = self.align(p)
            if len(p) <= longest:
                known[p] = found[p]
        return found

    def align(self, piece: str) -> tuple | None:
        """(n_a, n_b, n_groups and n_links, digest text, pairs, their
        occurrences) of one piece as it stands in a text, numbers as bytes of
        longs.
        The B model adds a space itself; a piece without one is encoded behind
        a letter."""
        a = self.a.encode(piece, add_special_tokens=False).ids
        spaced = piece[0] == " " and len(piece) > 1
        b = self.b.encode(piece[1:]) if spaced else self.b.encode("a" + piece)[self.lead:]
        of_a, of_b, data = self.a_bytes, self.b_bytes, piece.encode()
        if b"".join([of_a[i] for i in a]) != data or b"".join([of_b[i] for i in b]) != data:
            return None
        text, links, n_groups, n_links = [], Counter(), 0, 0
        i = j = ends_a = ends_b = 0
        while i < len(a):
            first_a, first_b = i, j
            ends_a, i = ends_a + len(of_a[a[i]]), i + 1
            ends_b, j = ends_b + len(of_b[b[j]]), j + 1
            while ends_a != ends_b:
                if ends_a < ends_b:
                    ends_a, i = ends_a + len(of_a[a[i]]), i + 1
                else:
                    ends_b, j = ends_b + len(of_b[b[j]]), j + 1
            own_a, own_b = a[first_a:i], b[first_b:j]
            text.append(f"{','.join(map(str, own_a))}|{','.join(map(str, own_b))};")
            n_groups += 1
            n_links += len(own_a) * len(own_b)
            right = Counter(own_b).items()
            for x, n in Counter(own_a).items():
                for y, m in right:
                    links[x << 32 | y] += n * m
        return (np.array((len(a), len(b), n_groups, n_links), np.int64).tobytes(), "".join(text),
                *(np.fromiter(x, np.int64, len(links)).tobytes() for x in (links, links.values())))

    def align_joined(self, pieces: list[str]) -> list[tuple] | None:
        """``align`` of short pieces that do not end with white space, encoded
        as one text behind a word (neither vocabulary sees over their borders);
        pairs are listed as often as they occur, occurrences are None.  None if
        the joined bytes or the borders do not fit."""
        pieces = [" a", *pieces]
        joined = "".join(pieces)
        data = joined.encode()
        a_list = self.a.encode_batch_fast([joined], add_special_tokens=False)[0].ids
        b_list = self.b.encode(joined[1:])
        if b"".join(map(self.a_bytes.__getitem__, a_list)) != data or \
                b"".join(map(self.b_bytes.__getitem__, b_list)) != data:
            return None
        a, b = np.array(a_list, np.int64), np.array(b_list, np.int64)
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        piece_end = np.cumsum([len(p.encode()) for p in pieces])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        last = np.searchsorted(cuts, piece_end)  # last group of each piece
        if not np.array_equal(cuts[last], piece_end):
            return None
        ga, gb = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        na, nb = np.bincount(ga, minlength=len(cuts)), np.bincount(gb, minlength=len(cuts))
        to_a, to_b = np.cumsum(na), np.cumsum(nb)
        # digest text: A tokens of a group, then its B tokens
        word = np.zeros(len(a) + len(b), np.int64)
        size_a, size_b = len(self.a_bytes), len(self.b_bytes)
        word[np.arange(len(a)) + (to_b - nb)[ga]] = a + size_a * np.append(ga[1:] != ga[:-1], True)
        word[np.arange(len(b)) + to_a[gb]] = 2 * size_a + b + size_b * np.append(
            gb[1:] != gb[:-1], True)
        text = list(map(self.spelled.__getitem__, word.tolist()))
        # all pairs of each group
        n_pairs = na * nb
        g = np.repeat(np.arange(len(cuts)), n_pairs)
        at = np.arange(len(g)) - np.repeat(np.cumsum(n_pairs) - n_pairs, n_pairs)
        codes = (a[(to_a - na)[g] + at // nb[g]] << 32 | b[(to_b - nb)[g] + at % nb[g]]).tobytes()
        ends = (to_a[last], to_b[last], last + 1, np.cumsum(n_pairs)[last])
        sizes = np.diff(np.stack(ends, axis=1), axis=0).tobytes()
        word_end, code_end = (ends[0] + ends[1]).tolist(), (8 * ends[3]).tolist()
        texts = ["".join(text[i:j]) for i, j in pairwise(word_end)]
        return [*zip([sizes[i:i + 32] for i in range(0, len(sizes), 32)], texts,
                     [codes[i:j] for i, j in pairwise(code_end)], [None] * len(texts), strict=True)]


def _spelled(token: str, back: dict[str, int]) -> bytes:
    """Bytes of a byte-level token; an added token that is no byte spelling is
    taken as its own text."""
    return bytes([back[c] for c in token]) if all(c in back for c in token) else token.encode()


@functools.lru_cache(maxsize=2)
def vocabularies(a_json: str, b_model: bytes) -> Vocabularies:
    """Built once per Python worker."""
    return Vocabularies(a_json, b_model)


def align_texts(texts: list[str | None], voc: Vocabularies) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, digest, pairs, occurrences) of each text;
    pairs ascend.  The texts' pieces are numbered and summed as arrays."""
    cut = [voc.cut(" " + t) if t else [] for t in texts]
    found = voc.aligned(set().union(*cut))
    number = dict(zip(found, range(len(found))))
    entries = [e or _UNFIT for e in found.values()]
    spelled = [e[1] for e in entries]
    pieces = list(map(number.__getitem__, chain.from_iterable(cut)))
    flat = np.array(pieces, np.int64)
    ends = np.cumsum([0, *map(len, cut)])
    unfit = np.array([e is _UNFIT for e in entries], bool)
    fits = np.diff(np.concatenate(([0], np.cumsum(unfit[flat])))[ends]) == 0
    digests = [_digest(pieces[i:j], spelled) if ok and i < j else ""
               for (i, j), ok in zip(pairwise(ends.tolist()), fits.tolist(), strict=True)]
    flat = flat[np.repeat(fits, np.diff(ends))]
    ends = np.cumsum(np.concatenate(([0], np.where(fits, np.diff(ends), 0))))
    # numbers of tokens, groups and links: sums over the pieces of a text
    size = np.frombuffer(b"".join([e[0] for e in entries]), np.int64).reshape(-1, 4)
    totals = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(size[flat], axis=0)))
    totals = np.diff(totals[ends], axis=0).tolist()
    return [(*t, d, *links) for t, d, links in zip(
        totals, digests, _links(flat, ends, entries, voc), strict=True)]


#: Entry of a piece whose bytes differ; its texts have no tokens.
_UNFIT = (bytes(32), "", b"", None)


def _digest(pieces: list[int], spelled: list[str]) -> str:
    sha = hashlib.sha256()
    for at in range(0, len(pieces), 65_536):  # a very long text is not joined whole
        part = "".join(map(spelled.__getitem__, pieces[at:at + 65_536]))
        sha.update((part if at + 65_536 < len(pieces) else part[:-1]).encode())
    return sha.hexdigest()


def _links(flat: np.ndarray, ends: np.ndarray, entries: list[tuple], voc: Vocabularies) -> list[tuple]:
    """(pairs, occurrences) of each text, whose piece numbers stand between
    ``ends``: the pairs of its different pieces are listed, then summed."""
    pairs = np.frombuffer(b"".join([e[2] for e in entries]), np.int64)
    size = np.array([len(e[2]) >> 3 for e in entries], np.int64)
    start = np.cumsum(size) - size
    each = np.ones(len(pairs), np.int64)
    for i in [i for i, e in enumerate(entries) if e[3] is not None]:
        each[start[i]:start[i] + size[i]] = np.frombuffer(entries[i][3], np.int64)
    # the longs of a text and a pair in one: ids of B, then of A, then the text
    of_b, of_a = len(voc.b_bytes), len(voc.a_bytes)
    pairs = (pairs >> 32) * of_b + (pairs & 0xFFFFFFFF)
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    keys, times = np.unique(text * max(len(entries), 1) + flat, return_counts=True)
    text, piece = keys // max(len(entries), 1), keys % max(len(entries), 1)
    reach = size[piece]
    at = np.repeat(start[piece] - np.cumsum(reach) + reach, reach) + np.arange(int(reach.sum()))
    key = np.repeat(text, reach) * (of_a * of_b) + pairs[at]
    n = np.repeat(times, reach) * each[at]
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    key, n = key[first], np.add.reduceat(n, first) if len(n) else n
    text, pair = key // (of_a * of_b), key % (of_a * of_b)
    codes = pair // of_b << 32 | pair % of_b
    bounds = np.searchsorted(text, np.arange(len(ends))).tolist()
    return [(codes[i:j], n[i:j]) for i, j in pairwise(bounds)]


_NONE = np.zeros(0, np.int64)


def _lists(values: list[np.ndarray], kind) -> pa.ListArray:
    flat = np.concatenate([_NONE, *values]).astype(kind)
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _totals(codes: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([_NONE, *codes]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, place, np.concatenate([_NONE, *n]))
    return keys, sums


def aligned_rows(docs: DataFrame, a_json: str, b_model: bytes) -> DataFrame:
    """Rows of three kinds: DOC, one per document with its pairs; VECTOR, a
    task's document counts of identity pairs by A id; PAIRS, its document
    counts of other pairs."""
    prepare(docs.sparkSession)

    def side(kind, ids, id_n, pairs, pair_n):
        empty = [[None]] * 6
        return batch(_ROW, [kind], *empty, [None], _lists([ids], np.int32), _lists([id_n], np.int64),
                     _lists([pairs], np.int64), _lists([pair_n], np.int64))

    def run(batches):
        from pyspark import TaskContext

        voc = vocabularies(a_json, b_model)
        same = voc.identity
        rid = TaskContext.get().partitionId() << 33
        vector = np.zeros(len(same), np.int64)
        held: list[np.ndarray] = []
        n_held = 0
        for b in batches:
            for lo, texts in portions(b.column(1)):
                done = align_texts(texts, voc)
                parts = [[], [], [], []]
                for *_, codes, n in done:
                    a = codes >> 32
                    regular = same[a] == (codes & 0xFFFFFFFF)
                    vector[a[regular]] += 1
                    rest = codes[~regular]
                    held.append(rest)
                    n_held += len(rest)
                    for p, v in zip(parts, (a[regular], n[regular], rest, n[~regular]), strict=True):
                        p.append(v)
                size = len(texts)
                yield batch(_ROW, [DOC] * size, np.arange(rid, rid + size),
                            b.column(0).slice(lo, size), *([d[i] for d in done] for i in range(5)),
                            _lists(parts[0], np.int32), *(_lists(p, np.int64) for p in parts[1:]))
                rid += size
                if n_held > FLUSH:
                    codes, n = np.unique(np.concatenate(held), return_counts=True)
                    held, n_held = [], 0
                    yield side(PAIRS, _NONE, _NONE, codes, n)
        if n_held:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            yield side(PAIRS, _NONE, _NONE, codes, n)
        there = np.flatnonzero(vector)
        yield side(VECTOR, there, vector[there], _NONE, _NONE)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, _ROW_DDL)


def align_tokenizers(docs: DataFrame, a_json: str, b_model: bytes,
                     hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    voc = vocabularies(a_json, b_model)
    rows = written(aligned_rows(docs, a_json, b_model), "align-rows")
    size = len(voc.identity)
    # one number per A id: bounded by the vocabulary
    vector = np.zeros(size, np.int64)
    counts = rows.where(F.col("kind") == VECTOR).select(
        F.explode(F.arrays_zip("ids", "id_n")).alias("e")).groupBy("e.ids").agg(
        F.sum("e.id_n").alias("n"))
    for a, n in counts.collect():
        vector[a] = n
    pairs = written(rows.where(F.col("kind") == PAIRS).select(
        F.explode(F.arrays_zip("pairs", "pair_n")).alias("e")).groupBy(
        F.col("e.pairs").alias("pair")).agg(F.sum("e.pair_n").alias("n")), "align-pairs")
    best = vector.copy()
    for a, n in pairs.groupBy(F.shiftright("pair", 32)).agg(F.max("n")).collect():
        best[a] = max(best[a], n)
    hot = np.array(sorted((r[0], r[1]) for r in pairs.orderBy(F.desc("n"), "pair").limit(
        hot_pairs).collect()), np.int64).reshape(-1, 2)
    out = pa.schema([*(_ROW.field(c) for c in ("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links",
                                              "groups_sha256")),
                     ("n_best", pa.int64()), ("count_sum", pa.int64()),
                     _ROW.field("pairs"), _ROW.field("pair_n")])

    def look_up(batches):
        for b in batches:
            n_best, count_sum = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)

            def add(row, a, count, n):
                np.add.at(count_sum, row, count * n)
                np.add.at(n_best, row, np.where(count == best[a], n, 0))

            def flat(name):
                col = b.column(b.schema.get_field_index(name))
                row = np.repeat(np.arange(b.num_rows), col.value_lengths().to_numpy())
                return row, col.flatten().to_numpy().astype(np.int64)

            row, a = flat("ids")
            add(row, a, vector[a], flat("id_n")[1])
            row, codes = flat("pairs")
            n = flat("pair_n")[1]
            at = np.searchsorted(hot[:, 0], codes)
            at[at == len(hot)] = 0
            here = hot[at, 0] == codes if len(hot) else np.zeros(len(codes), bool)
            add(row[here], codes[here] >> 32, hot[at[here], 1], n[here])
            ends = np.concatenate(([0], np.cumsum(np.bincount(row[~here], minlength=b.num_rows))))
            rest = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v[~here]))
                    for v in (codes, n)]
            keep = [b.column(b.schema.get_field_index(f.name)) for f in list(out)[:7]]
            yield batch(out, *keep, pa.array(n_best), pa.array(count_sum), *rest)

    part = rows.where(F.col("kind") == DOC).mapInArrow(
        look_up, "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                 "groups_sha256 string, n_best long, count_sum long, pairs array<long>, "
                 "pair_n array<long>")
    # the pairs that are not hot meet their counts by key
    top = rows.sparkSession.createDataFrame(
        [(i, int(best[i])) for i in np.flatnonzero(best).tolist()], "a int, best long")
    rest = part.select("rid", F.explode(F.arrays_zip("pairs", "pair_n")).alias("e")).select(
        "rid", F.col("e.pairs").alias("pair"), F.col("e.pair_n").alias("k"))
    counted = pairs.withColumn("a", F.shiftright("pair", 32).cast("int")).join(top, "a").select(
        "pair", "n", (F.col("n") == F.col("best")).alias("is_best"))
    rest = rest.join(counted, "pair").groupBy("rid").agg(
        F.sum(F.col("k") * F.col("n")).alias("more"),
        F.sum(F.when(F.col("is_best"), F.col("k")).otherwise(0)).alias("more_best"))
    zero = F.lit(0).cast("long")
    return part.drop("pairs", "pair_n").join(rest, "rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", zero)).alias("count_sum"), "groups_sha256")
