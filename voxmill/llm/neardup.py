"""Near-duplicate documents: MinHash signatures, banding, verification on full sets, connected components.

1. Each document becomes a set of word shingles and universal-hash minima, `ROWS` for each band.  Documents with the same set are
   one class, led by the least doc_id.
2. Signatures are cut into bands of `ROWS` minima; a bucket holds the classes that agree on a band.  Buckets never emit all
   pairs: each bucket elects the member that shares most buckets with others, and the members are paired with it.
3. Pairs whose signatures come near the threshold are verified on the full shingle sets; links make components.
4. Buckets that still hold several components have strays, members outside their leader's component.  Strays are
   compared with the bucket's members by a finer signature in bounded blocks, and near ones of other components are
   verified too, so a link that the leader doesn't see isn't lost.
5. Pairs meet their leader by a join; leaders of very many pairs are salted (a list of at most `HOT_KEYS` of them is
   broadcast).

There are as many bands as it takes that a pair at the threshold misses every bucket with a probability of `MISS` at most:
16 of 4 rows at 0.85 (7.4e-6), 22 at 0.8 (9.2e-6); the signature test
lies five deviations under the threshold, the finer one four.

Edge cases: documents without words link with nothing; null text is the empty text; rows with null doc_id stand alone
and are kept; repeated rows share one class, and `deduplicate` keeps one of them; one doc_id may stand on different texts,
which are judged each by its own set; empty tables give empty results; the kept rows carry all columns.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, durable, halves, map_arrow, shuffle_width, table, whole_text
from .components import components
from .fingerprints import mix
from .words import word_hashes

#: Minima of a band, and the chance that a pair at the threshold may share none.
ROWS, MISS = 4, 1e-5
#: Minima, one byte of each, of the finer signature by which strays are compared, and its deviations under the threshold.
FINE, FINE_DEVIATIONS = 512, 4
#: Bytes of text whose shingles a worker holds at once; a byte takes about 50 there.
SLICE_BYTES = 1 << 20
#: Strays, and members, that one block compares at once.
BLOCK_ROWS = 512
#: The most leaders whose pairs are salted, and the least number of pairs for it.
HOT_KEYS, HOT_PAIRS = 10_000, 1024
_ODD = np.uint64(0x9E3779B97F4A7C15)
_A = mix(np.arange(1, FINE + 1, dtype=np.uint64), 11) | np.uint64(1)
_B = mix(np.arange(1, FINE + 1, dtype=np.uint64), 12)


def shingle_sets(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of the distinct shingles, sorted by text and hash."""
    word, doc = word_hashes(texts)
    with np.errstate(over="ignore"):
        n = np.bincount(doc, minlength=len(texts))
        # every run of `words` words in one text; texts with fewer have one shingle of them all
        count = len(word) - words + 1
        inside = doc[: max(count, 0)] == doc[words - 1 :]
        h = np.zeros(max(count, 0), np.uint64)
        for k in range(words):
            h = (h * _ODD) + word[k : k + max(count, 0)]
        h, owner = mix(h[inside] + np.uint64(words), 15), doc[: max(count, 0)][inside]
        few = np.flatnonzero((n > 0) & (n < words))
        if len(few):
            start = np.searchsorted(doc, few)
            short = np.zeros(len(few), np.uint64)
            for k in range(words - 1):
                more = n[few] > k
                short[more] = short[more] * _ODD + word[start[more] + k]
            h, owner = np.concatenate([h, mix(short + n[few].astype(np.uint64), 16)]), np.concatenate([owner, few])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], owner[new]


def band_count(percent: int) -> int:
    return max(1, math.ceil(math.log(MISS) / math.log1p(-((min(percent, 99) / 100) ** ROWS))))


def signatures(h: np.ndarray, owner: np.ndarray, texts: int, hashes: int) -> np.ndarray:
    """[texts, hashes] 32-bit minima; texts without shingles have all ones."""
    out = np.full((texts, hashes), 0xFFFFFFFF, np.uint32)
    if len(h):
        there, start = np.unique(owner, return_index=True)
        with np.errstate(over="ignore"):
            for k in range(hashes):
                out[there, k] = np.minimum.reduceat(((h * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), start)
    return out


def sketch(batch: pa.RecordBatch, words: int, hashes: int) -> pa.RecordBatch:
    n = batch.num_rows
    h, owner = shingle_sets(batch.column(1).to_pylist(), words)
    size = np.bincount(owner, minlength=n)
    h1, h2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(h1, owner, mix(h, 17))
        np.bitwise_xor.at(h2, owner, mix(h, 18))
    sig = signatures(h, owner, n, hashes)
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(2), batch.column(3), pa.array(size, pa.int64()), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array([r.tobytes() for r in sig], pa.binary())],
        names=["doc_id", "t1", "t2", "n_shingles", "h1", "h2", "sig"],
    )


def fine_signatures(batch: pa.RecordBatch, words: int) -> pa.RecordBatch:
    h, owner = shingle_sets(batch.column(1).to_pylist(), words)
    sig = (signatures(h, owner, batch.num_rows, FINE) & np.uint32(255)).astype(np.uint8)
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in sig], pa.binary())], names=["id", "fine"])


def band_keys(sig: np.ndarray) -> np.ndarray:
    """[rows, bands] bucket keys."""
    count = sig.shape[1] // ROWS
    with np.errstate(over="ignore"):
        parts = sig.reshape(len(sig), count, ROWS).astype(np.uint64)
        key = np.tile(mix(np.arange(count, dtype=np.uint64), 19), (len(sig), 1))
        for k in range(ROWS):
            key = mix(key * _ODD + parts[:, :, k], 20)
    return key.view(np.int64)


def to_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), -1)


def bands(classes: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            if b.num_rows:
                keys = band_keys(to_matrix(b.column(1)))
                ids = np.repeat(b.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["key", "id"])

    return classes.select("id", "sig").mapInArrow(run, "key long, id long")


def with_both(pairs: DataFrame, held: DataFrame, column: str) -> DataFrame:
    """(a, b, xa, xb): pairs with what `held` (id, column) has of each; the pairs of a crowded b are dealt over salts."""
    total = pairs.count()
    least = max(HOT_PAIRS, total // HOT_KEYS)
    # at most total / least rows, HOT_KEYS
    hot = F.broadcast(pairs.groupBy(F.col("b").alias("_hot")).agg(F.ceil(F.count("*") / F.lit(least)).cast("int").alias("_n")).where("_n > 1"))
    one = pairs.join(held.select(F.col("id").alias("a"), F.col(column).alias("xa")), "a")
    one = one.join(hot, one["b"] == F.col("_hot"), "left").select("a", "b", "xa", F.pmod(F.xxhash64("a"), F.coalesce("_n", F.lit(1))).cast("int").alias("_salt"))
    many = held.join(hot, held["id"] == F.col("_hot"), "left")
    many = many.select(F.col("id").alias("b"), F.col(column).alias("xb"), F.explode(F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1)).alias("_salt"))
    return one.join(many, ["b", "_salt"]).select("a", "b", "xa", "xb")


def near_signatures(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose signatures agree in at least `least` of their places."""
    both = with_both(pairs, classes, "sig")

    def run(batches):
        for b in batches:
            if b.num_rows:
                same = (to_matrix(b.column(2)) == to_matrix(b.column(3))).mean(axis=1)
                yield pa.RecordBatch.from_arrays(b.columns[:2], names=["a", "b"]).filter(pa.array(same >= least))

    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have 100 * intersection >= percent * union."""
    two = with_both(pairs, texts, "text")

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        b_texts = batch.column(3).to_pylist()
        # rows come in runs of the same b: its set is made once for a run
        new = [k for k in range(len(b_texts)) if not k or b_texts[k] != b_texts[k - 1]]
        run = np.cumsum(np.isin(np.arange(len(b_texts)), new)) - 1
        ha, pa_ = shingle_sets(batch.column(2).to_pylist(), words)
        hb, pb = shingle_sets([b_texts[k] for k in new], words)
        na = np.bincount(pa_, minlength=len(run))
        nb = np.bincount(pb, minlength=len(new))[run]
        shared = np.zeros(len(run), np.int64)
        starts_b = np.searchsorted(pb, np.arange(len(new) + 1))
        starts_a = np.searchsorted(pa_, np.arange(len(run) + 1))
        for k, r in enumerate(run):
            x, y = ha[starts_a[k] : starts_a[k + 1]], hb[starts_b[r] : starts_b[r + 1]]
            if len(x) and len(y):
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                shared[k] = int((y[at] == x).sum())
        good = (100 * shared >= percent * (na + nb - shared)) & (shared > 0)
        return pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good))

    return map_arrow(two, check, "a long, b long", "xa", SLICE_BYTES)


def stray_pairs(members: DataFrame, least: float) -> DataFrame:
    """members (bucket rows: key, id, comp, sig, fine, n, strays, stray) -> near pairs of a stray and a row of another component.

    Buckets are cut into blocks of BLOCK_ROWS strays and as many members; a task holds one block, and only near pairs
    leave it, each from the first bucket that its two rows share.  Where both are strays, the pair comes from the greater
    id alone.  A row goes to as many blocks as there are lots of what it is compared with, so few strays cost few copies.
    """
    place = F.xxhash64("id")
    rows, lots = F.ceil(F.col("n") / BLOCK_ROWS).cast("int"), F.ceil(F.col("strays") / BLOCK_ROWS).cast("int")

    def blocks(upto: Column, make: Callable[[Column], Column]) -> Column:
        return F.transform(F.sequence(F.lit(0), upto - 1), make)

    def block(query: bool, i: Column, j: Column) -> Column:
        return F.struct(F.lit(query).alias("query"), i.cast("int").alias("i"), j.cast("int").alias("j"))

    as_member = blocks(lots, lambda i: block(False, i, F.pmod(place, rows)))
    as_stray = F.when(F.col("stray"), blocks(rows, lambda j: block(True, F.pmod(place, lots), j)))
    every = F.explode(F.concat(as_member, F.coalesce(as_stray, F.slice(as_member, 1, 0)))).alias("at")
    placed = members.where("strays > 0").select("key", "id", "comp", "sig", "fine", "stray", every)
    width = placed.select(F.xxhash64("key", "at.i", "at.j").alias("_block"), "key", "id", "comp", "sig", "fine", "at.query", "stray")

    def run(batches):
        held: list = []
        block = None

        def compare():
            table_ = pa.Table.from_batches(held).combine_chunks()
            query = table_.column("query").to_numpy()
            if not query.any():
                return None
            ids, comp, key, stray = (table_.column(c).to_numpy() for c in ("id", "comp", "key", "stray"))
            sig = np.frombuffer(b"".join(table_.column("fine").to_pylist()), np.uint8).reshape(-1, FINE)
            keys = band_keys(to_matrix(table_.column("sig").combine_chunks()))
            rest = np.flatnonzero(~query)
            out = []
            for q in np.flatnonzero(query):
                there = rest[(comp[rest] != comp[q]) & (key[rest] == key[q]) & (~stray[rest] | (ids[rest] < ids[q]))]
                if len(there):
                    there = there[np.count_nonzero(sig[there] == sig[q], axis=1) >= least * FINE]
                if len(there):
                    first = np.argmax(keys[there] == keys[q], axis=1)
                    there = there[keys[there, first] == key[q]]
                    out.append(np.stack([np.full(len(there), ids[q]), ids[there]]))
            if not out:
                return None
            a, b = np.concatenate(out, axis=1)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
            for lo, hi in zip(cuts, cuts[1:]):  # noqa: B905
                if hi == lo:
                    continue
                if block is not None and at[lo] != block:
                    if (found := compare()) is not None:
                        yield found
                    held.clear()
                block = at[lo]
                held.append(batch.slice(lo, hi - lo))
        if held and (found := compare()) is not None:
            yield found

    dealt = width.repartition(shuffle_width(members.sparkSession), "_block").sortWithinPartitions("_block")
    return dealt.select("_block", "key", "id", "comp", "sig", "fine", "query", "stray").mapInArrow(run, "a long, b long").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def groups(docs: DataFrame, words: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, t1, t2, n_shingles, h1, h2; classes: h1, h2, n_shingles, component_id, stays).

    A class is a set of shingles, numbered when it is written (doc_ids may clash).  component_id is the least doc_id of its
    component, `stays` the row (doc_id, t1, t2) of that doc_id that stands for all.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    slim = slim.select("doc_id", "text", *halves(F.sha2("text", 256)))
    hashes = ROWS * band_count(percent)
    least = percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / hashes) ** 0.5
    base = durable(map_arrow(slim, lambda b: sketch(b, words, hashes), "doc_id long, t1 long, t2 long, n_shingles long, h1 long, h2 long, sig binary", limit=SLICE_BYTES), "near-base")
    full = base.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("h1", "h2", "n_shingles").agg(F.min(F.struct("doc_id", "t1", "t2")).alias("led"), F.first("sig").alias("sig"))
    classes = durable(classes.withColumn("id", F.monotonically_increasing_id()), "near-classes")
    rows = durable(bands(classes), "near-bands")
    sizes = durable(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "near-sizes")
    shared = durable(rows.join(sizes, "key"), "near-shared")
    discard(rows, sizes)
    weight = durable(shared.groupBy("id").agg(F.sum("n").alias("w")), "near-weights")
    leaders = durable(shared.join(weight, "id").groupBy("key").agg(F.max(F.struct("w", (-F.col("id")).alias("m"))).alias("x")).select("key", (-F.col("x.m")).alias("leader")), "near-leaders")
    pairs = durable(shared.join(leaders, "key").where("id <> leader").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct(), "near-candidates")
    near = durable(near_signatures(pairs, classes, least), "near-pairs")
    wanted = classes.join(weight.select("id"), "id").select("id", "led")
    texts = slim.join(wanted, (slim["doc_id"] == F.col("led.doc_id")) & (slim["t1"] == F.col("led.t1")) & (slim["t2"] == F.col("led.t2"))).select("id", "text")
    texts = durable(texts, "near-texts")
    if texts.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():  # whole rows that repeat
        texts = durable(texts.dropDuplicates(["id"]), "near-texts-once")
    links = durable(verified(near, texts, words, percent), "near-links")
    discard(pairs, near)
    comp = durable(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "near-comp")
    # buckets with several components
    labelled = durable(shared.join(comp, F.col("id") == F.col("node"), "left").select("key", "id", "n", F.coalesce("component", "id").alias("comp")), "near-labelled")
    open_ = labelled.groupBy("key").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo <> _hi").select("key")
    lead = durable(open_.join(leaders, "key").join(comp, F.col("leader") == F.col("node"), "left").select("key", F.coalesce("component", "leader").alias("_lead")), "near-open")
    members = durable(labelled.join(lead, "key").select("key", "id", "comp", "n", (F.col("comp") != F.col("_lead")).alias("stray")), "near-members")
    crowd = durable(members.groupBy("key").agg(F.count_if("stray").alias("strays")), "near-crowd")
    discard(labelled, lead, leaders, weight, shared)
    again = texts.join(members.select("id").distinct(), "id", "left_semi")
    fine = durable(map_arrow(again, lambda b: fine_signatures(b, words), "id long, fine binary", limit=SLICE_BYTES), "near-fine")
    share = percent / 100
    least = share - FINE_DEVIATIONS * (share * (1 - share) / FINE) ** 0.5
    more = durable(stray_pairs(members.join(crowd, "key").join(fine, "id").join(classes.select("id", "sig"), "id"), least), "near-strays")
    found = durable(verified(more, texts, words, percent), "near-more")
    discard(members, crowd, fine, more, texts)
    if found.limit(1).count():
        comp = durable(components(links.unionByName(found).select(F.col("a").alias("u"), F.col("b").alias("v"))), "near-comp2")
    grouped = classes.select("id", "h1", "h2", "n_shingles", "led").join(comp, F.col("id") == F.col("node"), "left").withColumn("_c", F.coalesce("component", "id"))
    first = grouped.groupBy("_c").agg(F.min("led").alias("stays"))
    by_class = durable(grouped.join(first, "_c").select("h1", "h2", "n_shingles", F.col("stays.doc_id").alias("component_id"), "stays"), "near-classes2")
    discard(classes, links, found, comp)
    return base.drop("sig"), by_class


def link(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row."""
    rows, classes = groups(docs, words, percent)
    alone = rows.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    together = rows.where("n_shingles > 0 and doc_id is not null").join(classes, ["h1", "h2", "n_shingles"]).select("doc_id", "n_shingles", "component_id")
    return together.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of docs, all columns, of each group: of the least doc_id, and of its texts and repeated rows one.

    Rows without words or without doc_id are in no group and stay, each of them.
    """
    rows, classes = groups(docs, words, percent)
    linked = rows.where("n_shingles > 0 and doc_id is not null").join(classes, ["h1", "h2", "n_shingles"])
    own = F.struct("doc_id", "t1", "t2")
    # few rows: what goes, and rows that stay but stand there several times
    linked = linked.select(own.alias("own"), (own == F.col("stays")).alias("stays"))
    marks = linked.groupBy("own", "stays").agg(F.count("*").alias("n")).where("NOT stays OR n > 1")
    marks = durable(marks.select("own.*", "stays").select(F.col("doc_id").alias("_near_id"), F.col("t1").alias("_near_1"), F.col("t2").alias("_near_2"), F.col("stays").alias("_near_stays")), "near-marks")
    first, second = halves(F.sha2(whole_text(), 256))
    keyed = docs.withColumns({"_near_first": first, "_near_second": second})
    same = (keyed["doc_id"].cast("long") == F.col("_near_id")) & (keyed["_near_first"] == F.col("_near_1")) & (keyed["_near_second"] == F.col("_near_2"))
    kept = keyed.join(marks.where("NOT _near_stays"), same, "left_anti")
    if marks.where("_near_stays").limit(1).count():
        twice = marks.where("_near_stays").drop("_near_stays")
        once = kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", "_near_first", "_near_second"])
        kept = kept.join(twice, same, "left_anti").unionByName(once)
    return kept.drop("_near_first", "_near_second")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"), words=3, percent=85)
