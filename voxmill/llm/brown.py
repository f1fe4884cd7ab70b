"""Brown class n-grams: exchange clustering of words, class transitions and word emissions, perplexity of whole texts.

1. Texts are cut into tokens once, in chunks of at most about 4 MB of text; a chunk keeps its distinct words, how often
   its training documents hold each, and the texts as numbers of these words.  Chunks are written to the shared folder.
2. Words of all chunks are counted.  The commonest ones (`CORE`, seen `CORE_SEEN` times at least) are units of their own; each other
   word, unknown ones too, belongs to the unit of its ending (`ENDINGS` of them).  So every word is clustered, and what a worker must
   know of the units is bounded.
3. Pairs of neighbouring units are counted, and each unit gets one row of its neighbours on both sides.
4. Exchange: in each round, a third of the units (by turns) move to the class that raises the likelihood of the class bigrams most, by
   the exact change of the sum of n log n over classes.  Moves of a round are decided side by side and can spoil each other, so
   all of them, or only a share of the greatest gains, are made, whichever is likeliest; the search ends after `ROUNDS`,
   or when no part has anything to gain.
5. P(word | history) = P(class | two classes before) P(unit | class) P(word | unit).  Transitions are interpolated from three
   classes to one (Witten-Bell); a unit of an ending keeps a Witten-Bell share for unknown words, which count as one event there.
   Each factor sums to one.
6. Scores are sums over tokens.  The counts of a chunk's words that aren't core come by a join on the word.

Driver and workers hold at most CORE + ENDINGS units and (CLASSES + 1)^3 transitions; words, counts, pairs and texts stay distributed.
A worker unpacks an Arrow batch piece by piece: what it holds beside the batch doesn't grow with the batch, the partition or a unit's rows.

Edge cases: null text is the empty text, whose only token is the end; rows with null doc_id are for training; repeated
rows are rows of their own, in training too; words of any length are told apart whole, but one of over `LONGEST` bytes goes by its ending; ties of counts are
broken by the word's bytes, ties of classes by their number; without training documents every class, and every unit in it, is equally likely; a text of
any length is one document, and makes a chunk of its own beyond the chunk size; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, durable, slices, table, whole_text

#: Words that are units, the fewest times they are seen, and their greatest length in bytes.
CORE, CORE_SEEN, LONGEST = 16_384, 10, 64
#: Units of words by their last ENDING bytes.
ENDINGS, ENDING = 2_048, 3
#: Classes, without that of the end of a text; rounds of exchange.
CLASSES, ROUNDS = 64, 9
#: Parts of the units that move by turns, and of the moves, by falling gain, that are tried together.
PARTS, SHARES = 3, (1, 4, 16, 64, 256)
CHUNK_BYTES = 4 << 20
#: Units whose moves one product weighs at once.
MOVES = 64
#: Pairs that a task adds up before it sends them on, and the bits that their counts have there.
HELD_PAIRS, COUNT_BITS = 2_000_000, 34
#: Bytes of neighbours, and of the classes of texts, that a worker unpacks at once; a class becomes several numbers of 8 bytes.
PIECE_BYTES, CODED_BYTES = 2 << 20, 1 << 18
END = b""
U = CORE + ENDINGS
CHUNK = "chunk long, docs array<long>, tokens array<int>, ids binary, words array<binary>, seen array<long>"


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def packed(ids: np.ndarray) -> bytes:
    """Numbers under 2^32 by planes of bytes, which compress well."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to chunks; the end of a text is word 0."""
    part, k = TaskContext.get().partitionId(), 0
    for batch in batches:
        for piece in slices(batch, "text", CHUNK_BYTES):
            docs = piece.column(0).to_pylist()
            number, ids, sizes = {END: 0}, [], []
            for text in piece.column(1).to_pylist():
                words = text.encode("utf-8", "surrogatepass").lower().split()
                ids.append(np.array([number.setdefault(w, len(number)) for w in words] + [0], np.uint32))
                sizes.append(len(words) + 1)
            learnt = [x for d, x in zip(docs, ids, strict=True) if not held_out(d)]
            seen = np.bincount(np.concatenate(learnt), minlength=len(number)) if learnt else np.zeros(len(number), np.int64)
            row = {"chunk": (part << 33) + k, "docs": docs, "tokens": sizes, "ids": packed(np.concatenate(ids)), "words": list(number), "seen": seen.tolist()}
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], names=list(row))
            k += 1


def ending(word: bytes) -> int:
    """The unit of a word that isn't core."""
    return CORE + zlib.crc32(word[-ENDING:]) % ENDINGS


def units_of(words: list[bytes], core: dict[bytes, int]) -> np.ndarray:
    """Units of a chunk's words, of which the first is the end, whose unit is the last."""
    out = np.array([core[w] if w in core else ending(w) for w in words], np.int64)
    out[0] = U
    return out


def columns_of(batch: pa.RecordBatch, i: int) -> dict:
    """One chunk: its documents, sizes and numbers, its words, and where joined in, the packed counts of them."""
    at = {name: k for k, name in enumerate(batch.schema.names)}
    row = {"docs": batch.column(at["docs"])[i].as_py(), "tokens": batch.column(at["tokens"])[i].values.to_numpy(), "ids": unpacked(batch.column(at["ids"])[i].as_py())}
    row["words"] = batch.column(at["words"])[i].values.to_pylist()
    if "seen" in at:
        seen = batch.column(at["seen"])[i].values
        row["seen"] = np.empty(0, np.int64) if seen is None else seen.to_numpy()
    return row


def chunk_pairs(row: dict, core: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(a (U + 1) + b, times) of the units a, b that follow each other in a chunk's training documents."""
    learnt = np.repeat([not held_out(d) for d in row["docs"]], row["tokens"])
    unit = units_of(row["words"], core)[row["ids"][learnt]]
    # the end of one text stands before the first word of the next one
    return np.unique(np.concatenate([[U], unit[:-1]]) * (U + 1) + unit, return_counts=True) if len(unit) else (unit, unit)


def pieces(batch: pa.RecordBatch, *columns: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most `limit` bytes in these columns; a longer row stands alone."""
    sizes = [pa.compute.fill_null(pa.compute.binary_length(batch.column(batch.schema.get_field_index(c))), 0).to_numpy(zero_copy_only=False) for c in columns]
    ends = np.cumsum(np.sum(sizes, axis=0, dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def merged(held: np.ndarray, keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sorted distinct keys with their counts in the low bits, and further distinct ones added."""
    both = np.concatenate([held, keys << COUNT_BITS | n])
    both.sort()
    # a key stands at most twice
    twice = np.flatnonzero((both[1:] ^ both[:-1]) >> COUNT_BITS == 0)
    both[twice + 1] += both[twice] & ((1 << COUNT_BITS) - 1)
    return np.delete(both, twice)


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their sums."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def pairs(chunks: DataFrame, core) -> DataFrame:
    """(unit, other, n): how often `other` stands behind `unit`, added up over the chunks of a task as far as memory allows."""

    def part(batches):
        held, told = np.empty(0, np.int64), 0

        def out():
            keys = held >> COUNT_BITS
            return pa.RecordBatch.from_arrays([pa.array(keys // (U + 1), pa.int32()), pa.array(keys % (U + 1), pa.int32()), pa.array(held & ((1 << COUNT_BITS) - 1), pa.int64())], names=["unit", "other", "n"])

        for b in batches:
            for i in range(b.num_rows):
                row = columns_of(b, i)
                held, told = merged(held, *chunk_pairs(row, core.value)), told + len(row["ids"])
                # a chunk has under 2^32 tokens
                if len(held) > HELD_PAIRS or told >> (COUNT_BITS - 1):
                    yield out()
                    held, told = held[:0], 0
        yield out()

    return chunks.select("docs", "tokens", "ids", "words").mapInArrow(part, "unit int, other int, n long")


def lists(rows: DataFrame) -> DataFrame:
    """(unit, other, n) to a row for each unit: (unit, others, times), packed arrays in order of the others."""

    def part(batches):
        keys, n = np.empty(0, np.int64), np.empty(0, np.int64)

        def out(keys, n):
            unit = keys // (U + 1)
            first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            ends = np.append(first[1:], len(unit))
            others = (keys % (U + 1)).astype("<i4")
            return pa.RecordBatch.from_arrays([pa.array(unit[first], pa.int32()), pa.array([others[a:b].tobytes() for a, b in zip(first, ends, strict=True)]), pa.array([n[a:b].astype("<i8").tobytes() for a, b in zip(first, ends, strict=True)])], names=["unit", "others", "times"])

        for b in batches:
            # rows of one pair come one after the other, from as many tasks as made pairs: they are added up at once
            keys = np.concatenate([keys, b.column(0).to_numpy().astype(np.int64) * (U + 1) + b.column(1).to_numpy()])
            keys, n = summed(keys, np.concatenate([n, b.column(2).to_numpy()]))
            # the last unit may go on in the next batch
            whole = int(np.searchsorted(keys, keys[-1] // (U + 1) * (U + 1))) if len(keys) else 0
            if whole:
                yield out(keys[:whole], n[:whole])
                keys, n = keys[whole:], n[whole:]
        if len(keys):
            yield out(keys, n)

    return rows.repartition("unit").sortWithinPartitions("unit", "other").mapInArrow(part, "unit int, others binary, times binary")


def neighbours(chunks: DataFrame, core) -> DataFrame:
    """(unit, others, times, before, before_times) of every unit: the units behind it and before it, at most U + 1 of each."""
    behind = durable(lists(pairs(chunks, core)), "brown-behind")

    def turned(batches):
        for b in batches:
            for i in range(b.num_rows):
                other = np.frombuffer(b.column(1)[i].as_py(), "<i4")
                yield pa.RecordBatch.from_arrays([pa.array(other), pa.array(np.full(len(other), b.column(0)[i].as_py(), np.int32)), pa.array(np.frombuffer(b.column(2)[i].as_py(), "<i8"))], names=["unit", "other", "n"])

    before = lists(behind.mapInArrow(turned, "unit int, other int, n long")).withColumnsRenamed({"others": "before", "times": "before_times"})
    out = durable(behind.join(before.hint("merge"), "unit", "full"), "brown-neighbours")
    discard(behind)
    return out


def profiles(batch: pa.RecordBatch, *classes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each class map: (units, left and right counts by class, counts beside itself) of a batch of neighbours' rows."""
    unit, c = batch.column(0).to_numpy().astype(np.int64), CLASSES + 1
    sides = []
    for k in (3, 1):
        held = [[b or b"" for b in batch.column(x).to_pylist()] for x in (k, k + 1)]
        owner = np.repeat(np.arange(len(unit)), [len(b) // 4 for b in held[0]])
        other, n = np.frombuffer(b"".join(held[0]), "<i4"), np.frombuffer(b"".join(held[1]), "<i8")
        own = other == unit[owner]
        sides.append((owner[~own], other[~own], n[~own]))
        itself = np.bincount(owner[own], weights=n[own], minlength=len(unit))
    return [(unit, *[np.bincount(owner * c + m[other], weights=n, minlength=len(unit) * c).reshape(len(unit), c) for owner, other, n in sides], itself) for m in classes]


def nlog(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def gains(units: np.ndarray, left: np.ndarray, right: np.ndarray, own: np.ndarray, classes: np.ndarray, table_: np.ndarray) -> np.ndarray:
    """For each unit and class: the log likelihood with the unit there, less that of the table without the unit."""
    c = len(table_)
    k = np.arange(len(units))
    a = classes[units]
    m = np.repeat(table_[None], len(units), axis=0)
    m[k, a, :] -= right
    m[k, :, a] -= left
    m[k, a, a] -= own
    # the unit's neighbours stand before and after it wherever it goes
    before, after = m.sum(axis=2) + left, m.sum(axis=1) + right
    was = nlog(m)
    rows = nlog(m + right[:, None, :]) - was
    cols = nlog(m + left[:, :, None]) - was
    diagonal = np.arange(c)
    both = nlog(m[:, diagonal, diagonal] + left + right + own[:, None]) - was[:, diagonal, diagonal]
    out = rows.sum(axis=2) - rows[:, diagonal, diagonal] + cols.sum(axis=1) - cols[:, diagonal, diagonal] + both
    as_left, as_right = right.sum(axis=1) + own, left.sum(axis=1) + own
    out -= nlog(before + as_left[:, None]) - nlog(before) + nlog(after + as_right[:, None]) - nlog(after)
    out[:, CLASSES] = -np.inf
    return out


def likelihood(table_: np.ndarray) -> float:
    return float(nlog(table_).sum() - nlog(table_.sum(axis=0)).sum() - nlog(table_.sum(axis=1)).sum())


def class_tables(beside: DataFrame, maps: list[np.ndarray]) -> list[np.ndarray]:
    """How often each class follows each, under each class map."""
    c = CLASSES + 1

    def part(batches):
        out = np.zeros((len(maps), c, c))
        for b in batches:
            for piece in pieces(b, "others", "before"):
                for k, (unit, _, right, own) in enumerate(profiles(piece, *maps)):
                    np.add.at(out[k], maps[k][unit], right)
                    np.add.at(out[k], (maps[k][unit], maps[k][unit]), own)
        yield pa.RecordBatch.from_pydict({"e": pa.array(np.arange(out.size), pa.int32()), "v": pa.array(out.ravel())})

    found = beside.mapInArrow(part, "e int, v double").groupBy("e").agg(F.sum("v").alias("v")).orderBy("e").toArrow()["v"].to_numpy()
    return list(found.reshape(len(maps), c, c)) if len(found) else [np.zeros((c, c)) for _ in maps]


def best_moves(beside: DataFrame, classes: np.ndarray, counts: np.ndarray, turn: int) -> list[tuple[int, int, float]]:
    """(unit, class, gain) of the units of this turn that another class suits better, by falling gain."""

    def part(batches):
        for piece in (x for b in batches for x in pieces(b, "others", "before")):
            unit, *rest = profiles(piece, classes)[0]
            asked = np.flatnonzero((unit != U) & ((unit * 2654435761 % (1 << 32) >> 16) % PARTS == turn % PARTS))
            for at in range(0, len(asked), MOVES):
                some = asked[at : at + MOVES]
                gain = gains(unit[some], *[x[some] for x in rest], classes, counts)
                best = gain.argmax(axis=1)
                k = np.arange(len(some))
                more = gain[k, best] - gain[k, classes[unit[some]]]
                up = more > 1e-6
                yield pa.RecordBatch.from_pydict({"unit": pa.array(unit[some][up], pa.int32()), "class": pa.array(best[up], pa.int32()), "gain": more[up]})

    found = beside.mapInArrow(part, "unit int, class int, gain double").collect()
    return sorted(map(tuple, found), key=lambda m: (-m[2], m[0]))


def exchanged(beside: DataFrame, sizes: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, list[float]]:
    """(class of every unit, likelihoods of the rounds that stayed); at first the units are dealt to the classes by falling size."""
    classes = np.full(U + 1, CLASSES, np.int64)
    classes[np.argsort(-sizes[:U], kind="stable")] = np.arange(U) % CLASSES
    counts = class_tables(beside, [classes])[0]
    kept, idle = [likelihood(counts)], 0
    for turn in range(rounds):
        moves = best_moves(beside, classes, counts, turn)
        tried = []
        for part in SHARES:
            new = classes.copy()
            for unit, to, _ in moves[: -(-len(moves) // part)]:
                new[unit] = to
            tried.append(new)
        tables = class_tables(beside, tried) if moves else [counts]
        best = int(np.argmax([likelihood(m) for m in tables]))
        if likelihood(tables[best]) > kept[-1]:
            classes, counts, idle = tried[best], tables[best], 0
            kept.append(likelihood(counts))
        else:
            idle += 1
        if idle == PARTS:
            break
    return classes, kept


def transitions(coded: DataFrame) -> np.ndarray:
    """log10 P(class | two classes before), interpolated from the counts of one, two and three classes."""
    c = CLASSES + 1

    def part(batches):
        out = np.zeros(c**3, np.int64)
        for b in batches:
            for learnt in pieces(b.filter(pa.compute.invert(b.column(0))), "classes", limit=CODED_BYTES):
                first, before, now = histories(learnt.column(1))
                out += np.bincount((first * c + before) * c + now, minlength=c**3)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_pydict({"e": pa.array(at, pa.int32()), "v": pa.array(out[at], pa.int64())})

    found = coded.select("held_out", "classes").mapInArrow(part, "e int, v long").groupBy("e").agg(F.sum("v").alias("v")).toArrow()
    n3 = np.zeros(c**3)
    n3[found["e"].to_numpy()] = found["v"].to_numpy()
    return np.log10(interpolated(n3.reshape(c, c, c)))


def interpolated(n3: np.ndarray) -> np.ndarray:
    """Witten-Bell: each history keeps the share of its number of different followers for the shorter history."""
    n2 = n3.sum(axis=0)
    n1 = n2.sum(axis=0)
    p = (n1 + 1) / (n1.sum() + len(n1))
    for n in (n2, n3):
        total, kinds = n.sum(axis=-1, keepdims=True), (n > 0).sum(axis=-1, keepdims=True)
        p = np.where(total > 0, (n + kinds * p) / np.maximum(total + kinds, 1), p)
    return p


def histories(classes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(second class before, class before, class) of all tokens of texts, each of which ends with the class of the end."""
    sizes = np.diff(np.frombuffer(classes.buffers()[1], np.int32, len(classes) + 1, classes.offset * 4))
    low = int(np.frombuffer(classes.buffers()[1], np.int32, 1, classes.offset * 4)[0])
    now = np.frombuffer(classes.buffers()[2], np.uint8, int(sizes.sum()), low).astype(np.int64)
    before = np.concatenate([[CLASSES], now[:-1]])
    first = np.concatenate([[CLASSES], before[:-1]])
    first[np.cumsum(sizes) - sizes] = CLASSES
    return first, before, now


def coded_documents(chunks: DataFrame, counts: DataFrame, core, model: dict) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base, emission, classes): what a document's own words say, and their classes."""
    rare = chunks.select("chunk", F.posexplode("words").alias("at", "word"))
    known = counts.join(F.broadcast(core), "word", "left_anti").withColumnRenamed("word", "_w").hint("merge")
    # place and count in one number: a chunk has under 2^27 words, and a word that isn't core is seen less than 2^36 times
    packed_ = F.col("at").cast("long") * (1 << 36) + F.col("c")
    seen = rare.join(F.broadcast(core), "word", "left_anti").join(known, F.col("word") == F.col("_w")).groupBy("chunk").agg(F.collect_list(packed_).alias("seen"))
    whole = chunks.select(F.col("chunk").alias("_chunk"), "docs", "tokens", "ids", "words").join(seen.hint("merge"), F.col("_chunk") == F.col("chunk"), "left").drop("chunk", "_chunk")
    sent = chunks.sparkSession.sparkContext.broadcast(model)
    shape = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, emission double, classes binary"

    def part(batches):
        m = sent.value
        for row in (columns_of(b, i) for b in batches for i in range(b.num_rows)):
            unit = units_of(row["words"], m["core"])
            c = np.where(unit < CORE, m["seen"][unit], 0)
            c[row["seen"] >> 36] = row["seen"] & ((1 << 36) - 1)
            c[0] = m["texts"]
            share = np.where((unit >= CORE) & (unit < U), m["known"][unit] + np.log10(np.maximum(c, 1)), 0.0)
            share = np.where((unit >= CORE) & (unit < U) & (c == 0), m["unknown"][unit], share)
            ids = row["ids"]
            at = np.cumsum(row["tokens"]) - row["tokens"]
            classes = m["classes"][unit][ids].astype(np.uint8).tobytes()
            sums = [np.add.reduceat(x[ids], at) for x in (np.log10(c + 1.0), m["unit"][unit] + share)]
            held = [held_out(d) for d in row["docs"]]
            texts = [classes[a : a + n] for a, n in zip(at, row["tokens"], strict=True)]
            arrays = [pa.array(row["docs"], pa.int64()), pa.array(held), pa.array(row["tokens"], pa.int64()), pa.array(np.add.reduceat((c > 0)[ids].astype(np.int64), at)), *map(pa.array, sums), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in shape.split(", ")])

    return whole.mapInArrow(part, shape)


def emissions(classes: np.ndarray, seen: np.ndarray, core: int, texts: int, endings: dict[int, tuple[int, int]]) -> dict:
    """log10 P(unit | class) by unit, and of endings log10 of 1 / (n + kinds + 1) and of the unknown words' share."""
    n = np.zeros(U + 1)
    n[:CORE] = seen[:CORE] + 1
    n[core:CORE] = 0
    tokens, kinds = np.zeros(U + 1), np.zeros(U + 1)
    for u, (t, k) in endings.items():
        tokens[u], kinds[u] = t, k
    n[CORE:U] = tokens[CORE:U] + 1
    n[U] = texts + 1
    whole = np.bincount(classes, weights=n, minlength=CLASSES + 1)
    with np.errstate(divide="ignore"):
        unit = np.where(n > 0, np.log10(n) - np.log10(whole[classes]), 0.0)
    return {"unit": unit, "known": -np.log10(tokens + kinds + 1), "unknown": np.log10(kinds + 1) - np.log10(tokens + kinds + 1)}


def score_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity)."""
    spark = docs.sparkSession
    chunks = durable(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(encode, CHUNK), "brown-chunks")
    words = chunks.select("seen", F.posexplode("words").alias("at", "word")).select("word", F.get("seen", "at").alias("n")).where("n > 0")
    counts = durable(words.groupBy("word").agg(F.sum("n").alias("c")), "brown-counts")
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    common = counts.where((F.col("c") >= CORE_SEEN) & (F.octet_length("word") <= LONGEST) & (F.octet_length("word") > 0)).orderBy(F.desc("c"), "word").limit(CORE).collect()
    core = {bytes(r.word): i for i, r in enumerate(common)}
    # at most CORE words of LONGEST bytes, and the end
    named = spark.createDataFrame(pa.table({"word": pa.array([END, *core], pa.binary())}))
    sent = spark.sparkContext.broadcast(core)
    beside = neighbours(chunks, sent)
    texts = sum(r.c for r in counts.where(F.octet_length("word") == 0).collect())
    seen = np.array([r.c for r in common] + [0] * (U + 1 - len(common)), np.int64)
    rare = counts.join(F.broadcast(named), "word", "left_anti")
    unit = F.crc32(F.expr(f"substring(word, -{ENDING}, {ENDING})")) % ENDINGS + CORE
    endings = {r.unit: (r.n, r.kinds) for r in rare.groupBy(unit.alias("unit")).agg(F.sum("c").alias("n"), F.count("*").alias("kinds")).collect()}
    sizes = seen.copy()
    for u, (n, _) in endings.items():
        sizes[u] = n
    classes, _ = exchanged(beside, sizes, rounds)
    model = {"core": core, "seen": seen, "texts": texts, "classes": classes} | emissions(classes, seen, len(core), texts, endings)
    coded = durable(coded_documents(chunks, counts, named, model), "brown-coded")
    discard(chunks, counts, beside)
    table_ = spark.sparkContext.broadcast(transitions(coded))

    def part(batches):
        for b in batches:
            for piece in pieces(b, "classes", limit=CODED_BYTES):
                texts_ = piece.column(1)
                first, before, now = histories(texts_)
                sizes = pa.compute.binary_length(texts_).to_numpy()
                sums = np.add.reduceat(table_.value[first, before, now], np.cumsum(sizes) - sizes)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(sums), *piece.columns[2:]], names=["doc_id", "path", *piece.schema.names[2:]])

    rows = coded.select("doc_id", "classes", "held_out", "n_tokens", "n_known", "base", "emission")
    found = rows.mapInArrow(part, "doc_id long, path double, held_out boolean, n_tokens long, n_known long, base double, emission double")
    score = F.col("path") + F.col("emission")
    base = F.col("base") - F.col("n_tokens") * F.log10(F.lit(float(total + kinds + 1)))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"), F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
