"""Token sequences packed by a grouping genetic algorithm, on islands with migration of the elite.

Texts are tokenized once; what is packed are lengths. A full piece is a sequence. All others are dealt to lots of a few
thousand pieces. A lot is packed on several islands, each with a population of packings: crossover puts whole
well-filled bins of one parent into the other, takes out the bins that hold a piece twice, lets pieces that lost their
bin replace smaller ones where that fills a bin better, and best-fits the rest, longest first. After an epoch the best
packing of each island (its elite) goes to the next island of the lot as a whole and joins the population there; after the
last epoch the best packing of the lot stands. An island ends early where no packing can have fewer bins.

Bins that are full, or lack few enough tokens, are final; the others are dealt anew into fewer lots, where a bin stays
together as part of a starting packing, until one lot is left.

With an order (that of a mixing schedule) lots are ranges of it, of about equal size in each round and half as large, instead
of dealt by hash, and sequences are numbered by it: a sequence stands at the mean place of its tokens. A round moves tokens only
within its lots, so a prefix of the sequences differs from the prefix of the order by at most the lot at its end
in each round, whatever the amount of data.

Defined results: a null or empty text is its end token alone; rows that are repeated are packed each; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspark.llm.frames import map_arrow, numbered, small_batches, written

#: Pieces of a lot, islands of a lot, packings of an island, generations of an epoch.
LOT, ISLANDS, POPULATION, GENERATIONS = 2500, 3, 4, 6
#: Tokens that a bin may lack and still be final, by round.
SLACK = (0, 1, 2, 4, 8, 16, 32)


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """ids of a text by the tokenizer file; byte-level files without added tokens in the text take a faster engine.

    The faster engine has the same ranks and split pattern; its ids are equal, and tests hold them against the
    tokenizer's own.
    """
    import json

    import tiktoken
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    slow = lambda text: np.array(own.encode(text, add_special_tokens=False).ids, np.uint32)
    model, pre = spec.get("model", {}), spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer"):
        return slow
    # The public alphabet of byte-level tokenizers
    shown = [b for r in ((33, 127), (161, 173), (174, 256)) for b in range(*r)]
    back = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    added = [t["content"] for t in spec.get("added_tokens", [])]
    ranks = {bytes(back[c] for c in piece): i for piece, i in model["vocab"].items() if piece not in added}
    import public_tokenizers

    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: slow(text) if any(a in text for a in added) else fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())


def cut_pieces(docs: DataFrame, *, tokenizer: str, end: int, limit: int, doc_id: str, text: str, order: tuple[str, ...] = (), ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; only the first piece of a text is shorter than limit.

    Pieces of a text have its columns of order, as _o0, _o1 and so on; ids: whether the token ids come too.
    """
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"), *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)])
    carried = frame.columns[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in small_batches(batches, "_text"):
            rows, told = [], []
            for d, t, *o in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                found = np.append(encode(t or "") if t else np.zeros(0, np.uint32), np.uint32(end)).astype("<u4")
                start = 0
                for k, stop in enumerate(list(range(len(found), 0, -limit))[::-1]):
                    rows.append((d, k, start, stop - start, zlib.crc32(found[start:stop].tobytes()), *o))
                    told.append(found[start:stop])
                    start = stop
            types = (batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), *batch.schema.types[2:])
            if rows:
                made = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", *carried]
                if ids:
                    stops = np.concatenate([[0], np.cumsum([len(x) for x in told])]).astype(np.int32)
                    made.append(pa.ListArray.from_arrays(pa.array(stops), pa.array(np.concatenate(told).astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(made, names=names)

    types = "".join(f", {c} {frame.schema[c].dataType.simpleString()}" for c in carried) + ", ids array<int>" * ids
    return map_arrow(frame, run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint{types}")


def filled(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Tokens of each bin; at has the bin of each piece, -1 for none."""
    held = at >= 0
    return np.bincount(at[held], size[held]).astype(np.int64)


def best_fit(at: np.ndarray, size: np.ndarray, limit: int) -> np.ndarray:
    """The packing with the pieces that have no bin added, longest first, each to the fullest bin that takes it."""
    at, fill = at.copy(), filled(at, size)
    lost = np.flatnonzero(at < 0)
    own, n = size.tolist(), len(fill)
    many = len(at) + n + 1
    room = sorted((limit - f) * many + k for k, f in enumerate(fill.tolist()))
    for i in lost[np.lexsort((lost, -size[lost]))].tolist():
        j = bisect_left(room, own[i] * many)
        if j < len(room):
            left, k = divmod(room.pop(j), many)
        else:
            left, k, n = limit, n, n + 1
        at[i] = k
        insort(room, (left - own[i]) * many + k)
    return at


def replaced(at: np.ndarray, size: np.ndarray, limit: int, passes: int = 3) -> np.ndarray:
    """The packing after pieces without a bin took the places of smaller ones, which fills those bins better."""
    at = at.copy()
    for _ in range(passes):
        lost, held = np.flatnonzero(at < 0), np.flatnonzero(at >= 0)
        if not len(lost) or not len(held):
            break
        lost = lost[np.argsort(size[lost], kind="stable")]
        room = limit - filled(at, size)
        j = np.searchsorted(size[lost], size[held] + room[at[held]], side="right") - 1
        gain = np.where(j >= 0, size[lost[np.maximum(j, 0)]] - size[held], 0)
        good = np.flatnonzero(gain > 0)
        good = good[np.argsort(-gain[good], kind="stable")]
        for key in (at[held], j):  # one for each bin, and each piece once
            good = good[np.sort(np.unique(key[good], return_index=True)[1])]
        if not len(good):
            break
        at[lost[j[good]]] = at[held[good]]
        at[held[good]] = -1
    return at


def crossover(a: np.ndarray, b: np.ndarray, size: np.ndarray, limit: int, rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of a put into b."""
    fill = filled(a, size)
    top = np.argsort(-fill, kind="stable")[: max(1, len(fill) // 2)]
    top = top[rng.random(len(top)) < rng.uniform(0.2, 0.8)]
    given = np.isin(a, top)
    child = np.where(np.isin(b, b[given]), -1, b)
    # some of the emptiest bins are opened again
    fill = np.bincount(child[child >= 0], size[child >= 0], minlength=len(child))
    kept = np.unique(child[child >= 0])
    spare = kept[np.argsort(fill[kept], kind="stable")][: 1 + int(rng.integers(max(1, len(kept) // 20) + 1))]
    child[np.isin(child, spare)] = -1
    child[given] = len(child) + a[given]
    some = child >= 0
    child[some] = np.unique(child[some], return_inverse=True)[1]
    return best_fit(replaced(child, size, limit), size, limit)


def fitness(at: np.ndarray, size: np.ndarray, limit: int) -> tuple[int, float]:
    """Fewer bins are better, then fuller ones."""
    fill = filled(at, size)
    return -len(fill), float(((fill / limit) ** 2).sum())


def evolve(size: np.ndarray, limit: int, elites: list[np.ndarray], seed: int) -> np.ndarray:
    """The best packing found; elites are packings, of all pieces or some, that the population starts with."""
    least = -(-int(size.sum()) // limit)
    none = np.full(len(size), -1)
    rate = lambda at: fitness(at, size, limit)
    population = sorted([best_fit(at, size, limit) for at in [*elites, none]], key=rate, reverse=True)
    rng = np.random.Generator(np.random.PCG64(seed))
    while len(population) < POPULATION and -rate(population[0])[0] > least:
        # a quarter of the pieces first, in bins of their own, then the others
        start, first = none.copy(), rng.permutation(len(size))[: len(size) // 4]
        start[first] = best_fit(none[first], size[first], limit)
        population.append(best_fit(start, size, limit))
    for _ in range(GENERATIONS):
        if -rate(population[0])[0] <= least:
            break
        half = population[: POPULATION // 2]
        made = [crossover(half[int(rng.integers(len(half)))], population[int(rng.integers(len(population)))], size, limit, rng) for _ in range(POPULATION - len(half))]
        population = sorted([*half, *made], key=rate, reverse=True)
    return population[0]


def _numbers(bins: pd.Series) -> np.ndarray:
    return np.unique(bins.to_numpy(), return_inverse=True)[1]


def _first_epoch(limit: int, round_: int):
    """Of a lot on an island: its elite for itself, and for the next island as a guest."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row", kind="stable").reset_index(drop=True)
        island, lot = int(pdf["island"].iloc[0]), int(pdf["lot"].iloc[0])
        size = pdf["length"].to_numpy()
        pdf["at"] = evolve(size, limit, [_numbers(pdf["bin"])] if round_ else [], seed=((round_ * ISLANDS + island) << 40) + lot)
        return pd.concat([pdf.assign(guest=False), pdf.assign(island=(island + 1) % ISLANDS, guest=True)])

    return run


def _last_epoch(limit: int, round_: int, last: bool):
    """Of a lot on an island, with its own elite and that of the island before: its best packing."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["guest", "row"], kind="stable")
        own, guest = pdf[~pdf["guest"]].reset_index(drop=True), pdf[pdf["guest"]]
        island, lot = int(own["island"].iloc[0]), int(own["lot"].iloc[0])
        size = own["length"].to_numpy()
        at = evolve(size, limit, [own["at"].to_numpy(), guest["at"].to_numpy()], seed=((round_ * ISLANDS + island) << 40) + lot + (1 << 39))
        fill = filled(at, size)
        order = np.argsort(at, kind="stable")
        before = np.cumsum(size[order]) - size[order]
        offset = np.empty(len(at), np.int64)
        offset[order] = before - np.concatenate([[0], np.cumsum(fill)])[at[order]]
        bins, told = fitness(at, size, limit)
        done = np.ones(len(at), bool) if last else fill[at] >= limit - SLACK[min(round_, len(SLACK) - 1)]
        number = ((round_ << 42) + (lot << 13) + at.astype(np.int64)) * 2 + 1
        return own.drop(columns=["at", "guest"]).assign(bin=number, offset=offset, final=done, bins=-bins, fill=told)

    return run


def _in_ranges(open_: DataFrame, lots: int) -> DataFrame:
    """open_ with its lot: so many ranges of bins, by the mean place of their tokens."""
    bins = open_.groupBy("bin").agg(F.expr("sum(row * length) DIV sum(length)").alias("_at_row"))
    placed, n = numbered(bins, ["_at_row", "bin"], "_n", "pack-bins")
    return open_.join(placed.select("bin", F.expr(f"_n DIV {-(-n // lots)}").alias("lot")), "bin")


def pack(pieces: DataFrame, *, limit: int, rounds: int = 8, order: list[str] | None = None) -> DataFrame:
    """pieces (with length up to limit) with sequence_id and offset; with order, sequence_id goes by it from 0."""
    names = [c for c in pieces.columns if not (order and c in order and c.startswith("_o"))]
    rows = written(pieces.withColumn("_id", F.monotonically_increasing_id()), "pack-pieces")
    if order:
        narrow, _ = numbered(rows.select("_id", "length", *order), [*order, "_id"], "row", "pack-order")
        narrow = narrow.select("_id", "length", "row")
    else:
        narrow = rows.select("_id", "length", F.col("_id").alias("row"))
    placed = [narrow.where(F.col("length") >= limit).select("_id", "row", "length", (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))]
    open_ = narrow.where(F.col("length") < limit).withColumn("bin", F.col("row"))
    carried = "_id bigint, length bigint, row bigint, bin bigint, lot bigint, island int"
    left, stalled = open_.count(), False
    for round_ in range(rounds):
        if not left:
            break
        lots = -(-left * (2 if order else 1) // LOT)
        last = stalled or lots == 1 or round_ == rounds - 1
        dealt = _in_ranges(open_, lots) if order else open_.withColumn("lot", F.pmod(F.xxhash64(F.lit(round_), "bin"), F.lit(lots)))
        dealt = dealt.select("_id", "length", "row", "bin", F.col("lot").cast("bigint").alias("lot"), F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"))
        elite = dealt.groupBy("lot", "island").applyInPandas(_first_epoch(limit, round_), f"{carried}, at bigint, guest boolean")
        found = elite.groupBy("lot", "island").applyInPandas(_last_epoch(limit, round_, last), f"{carried}, offset bigint, final boolean, bins bigint, fill double")
        found = written(found, "pack-round")
        best = found.groupBy("lot").agg(F.min(F.struct("bins", -F.col("fill"), "island")).alias("_best")).select("lot", F.col("_best.island").alias("island"))
        found = written(found.join(best, ["lot", "island"]).select("_id", "length", "row", "bin", "offset", "final"), "pack-best", drop=(found,))
        placed.append(found.where("final").select("_id", "row", "length", F.col("bin").alias("sequence_id"), "offset"))
        if last:
            break
        open_ = found.where("NOT final").select("_id", "length", "row", "bin")
        now = open_.count()
        left, stalled = now, now > 0.9 * left
    out = placed[0]
    for part in placed[1:]:
        out = out.unionByName(part)
    if order:
        made = out.groupBy("sequence_id").agg(F.expr("sum(row * length) DIV sum(length)").alias("_at_row"))
        told, _ = numbered(made, ["_at_row", "sequence_id"], "_n", "pack-sequences")
        out = out.join(told.drop("_at_row"), "sequence_id").select("_id", F.col("_n").alias("sequence_id"), "offset")
    return rows.select("_id", *names).join(out.select("_id", "sequence_id", "offset"), "_id").select(*names, "sequence_id", "offset")


def pack_texts(docs: DataFrame, *, tokenizer: str, end: int = 2, limit: int = 1024, doc_id: str = "doc_id", text: str = "text", order: tuple[str, ...] = (), ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every text; with ids, also its token ids.

    order: columns by which the texts go; the sequences then follow it.
    """
    pieces = cut_pieces(docs, tokenizer=tokenizer, end=end, limit=limit, doc_id=doc_id, text=text, order=order, ids=ids)
    by = [f"_o{k}" for k in range(len(order))] + ["doc_id", "piece", "ids_crc32"]
    return pack(pieces, limit=limit, order=by if order else None)
