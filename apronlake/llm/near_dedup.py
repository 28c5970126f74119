"""Near-duplicate detection: DartMinHash signatures, banded joining, exact verification.

Similarity is the weighted Jaccard similarity of two texts' multisets of runs of five
words (a text of one to four words has one run): sum of minima over sum of maxima of the
counts. Texts of a similarity of ``threshold`` (0.8) or more are linked; a class is a
connected component of links, named by its smallest doc_id, which is the one to keep.

Signatures. Each run is an element with a region [0, weight) x [0, rank limit). Darts
fall on all elements' half-planes as a Poisson process that is a function of hashes
only: each unit cell of an element has a hashed Poisson(1) number of darts, each dart a
hashed place in the cell and a hashed coordinate. A text keeps, per coordinate, the dart
of lowest rank within its weights. With k ln k + 2 k darts expected in the region of a
text (rank limit = that over its weight), whatever its length, nearly all coordinates
are hit at once; a text with an empty coordinate is thrown again at twice the limit.

Joining. Signatures are cut into ``bands`` bands; a pair of similarity 0.8 shares one
with probability 0.9999 (24 bands of 5). Equal texts are first joined by digest, and one
of each goes on. Within a band's bucket pairs are not listed. First every member is
compared with the bucket's pivot, the member that meets most others over all its buckets;
among near copies that is the text the others stem from. Then components are named, and
only buckets that hold several are looked at again: in those of up to ``small`` members
every pair of different components is compared; the members of larger ones go with their
texts to a task, cut into blocks of bounded size, a task for each pair of blocks, where
runs are made once and each text outside the main component is held against all others of
another component and of a fitting length. So after it any two texts of different classes
that share a bucket have been compared (or are too unlike in length): what can be missed is
only a pair that shares no band. Among links to the pivot work is linear in the members of
buckets; it is quadratic only in the texts of a bucket that are no near copies of the others.

Texts are known by their digest throughout, so that rows of a null or repeated doc_id are
compared by what they hold; numbers given to distinct texts once they are written stand for
them in buckets and links.

Cases. Null, empty and white-space texts have no runs: each is a class of its own.
Repeated rows (same doc_id and text) share a class and are both kept or both not. Rows of
one doc_id and different texts are compared like any two. Ties: smallest doc_id, then
smallest digest. Null doc_id: compared like any, last in order; a class of null ids only
has a null name. Very long texts are read whole. Empty table: no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import NO_ID, distil, settle, table, with_key
from .wordhash import find_words, grams, mix, slices

SHINGLE = 5
#: Bytes of text at a time: the darts of so many texts stay in a core's cache.
SLICE = 1 << 18
_U = np.uint64


def _poisson_steps() -> np.ndarray:
    """Poisson(1) distribution function, scaled to 64 bits: 13 darts in a cell at most."""
    total = term = np.exp(-1.0)
    steps = [total]
    for i in range(1, 13):
        term /= i
        total += term
        steps.append(total)
    return (np.minimum(np.array(steps), 1 - 2.0**-52) * 2.0**64).astype(np.uint64)


_POISSON = _poisson_steps()


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> _U(11)).astype(np.float64) * 2.0**-53


def weighted_runs(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, run, count), sorted by document and run."""
    w = find_words(data, offsets)
    g, doc, _ = grams(w, w.hashes(), n, short=True)
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], g[at], np.diff(np.append(at, len(g)))


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int, seed: int = 1) -> np.ndarray:
    """n_docs x k dart ids; rows of documents without elements are 0.

    ``weight`` may be any positive number: darts beyond it in a cell do not count.
    """
    signature = np.zeros((n_docs, k), dtype=np.uint64)
    totals = np.bincount(doc, weights=weight, minlength=n_docs)
    limit = np.zeros(n_docs)
    has = totals > 0
    limit[has] = k * (np.log(k) + 2) / totals[has]
    todo = np.flatnonzero(has)
    while len(todo):
        mine = np.zeros(n_docs, dtype=bool)
        mine[todo] = True
        rows = mine[doc]
        d, e, w = doc[rows], element[rows], weight[rows].astype(np.float64)
        across, up = np.ceil(w).astype(np.int64), np.ceil(limit[d]).astype(np.int64)
        cells = across * up
        at = np.repeat(np.arange(len(d)), cells)
        within = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
        column, row = within % across[at], within // across[at]
        key = mix(e[at] + mix(column.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F) + row.astype(np.uint64) * _U(0x165667B19E3779F9) + _U(seed)))
        darts = np.searchsorted(_POISSON, key, side="right")
        found = []
        for i in range(int(darts.max(initial=0))):
            live = np.flatnonzero(darts > i)
            dart = mix(key[live] + _U((i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            rank = row[live] + _unit(mix(dart + _U(1)))
            who = at[live]
            ok = rank < limit[d[who]]
            if (w != across).any():
                ok &= column[live] + _unit(mix(dart + _U(2))) < w[who]
            found.append((d[who[ok]], dart[ok], rank[ok]))
        if found:
            owner, dart, rank = (np.concatenate(x) for x in zip(*found))
            spot = owner * k + (mix(dart + _U(3)) % _U(k)).astype(np.int64)
            order = np.lexsort((dart, rank, spot))
            spot = spot[order]
            first = np.ones(len(spot), dtype=bool)
            first[1:] = spot[1:] != spot[:-1]
            flat = signature.reshape(-1)
            flat[spot[first]] = dart[order[first]]
        todo = todo[(signature[todo] == 0).any(axis=1)]
        signature[todo] = 0
        limit[todo] *= 2
    return signature


def band_hashes(signature: np.ndarray, bands: int) -> np.ndarray:
    n, k = signature.shape
    h = np.zeros((n, bands), dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    parts = signature.reshape(n, bands, k // bands)
    for i in range(k // bands):
        h = mix(h + parts[:, :, i])
    return h


def _sketcher(bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1), SLICE):
                doc, run, count = weighted_runs(data, offsets)
                n = b - a
                sig = dart_signatures(doc, run, count, n, bands * rows)
                full = np.bincount(doc, minlength=n) > 0
                h = band_hashes(sig, bands).view(np.int64)
                starts = np.concatenate([[0], np.cumsum(np.where(full, bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(h[full].reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, n), batch.column(2).slice(a, n), lists], names=["at", "digest", "bands"])

    return sketch


def weighted_jaccard(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Similarity of the i-th left and i-th right text."""
    out = np.zeros(len(left))
    both = pa.concat_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (left, right)])
    n = len(left)
    # Interleave, so that the two texts of a pair lie in one slice.
    order = np.arange(2 * n).reshape(2, n).T.reshape(-1)
    a = 0
    sizes = pa.compute.binary_length(both).to_numpy(zero_copy_only=False).astype(np.int64)
    pair_end = np.cumsum(sizes[:n] + sizes[n:])
    while a < n:
        base = pair_end[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(pair_end, base + (2 << 20), side="right")))
        texts = both.take(pa.array(order[2 * a : 2 * b]))
        for _, _, data, offsets in slices(texts, limit=1 << 62):
            doc, run, count = weighted_runs(data, offsets)
            pair = doc // 2
            o = np.lexsort((doc, run, pair))
            pair, run, count, side = pair[o], run[o], count[o], doc[o] % 2
            same = np.flatnonzero((pair[1:] == pair[:-1]) & (run[1:] == run[:-1]) & (side[1:] != side[:-1]))
            low = np.bincount(pair[same], weights=np.minimum(count[same], count[same + 1]), minlength=b - a)
            every = np.bincount(pair, weights=count, minlength=b - a)
            out[a:b] = low / np.maximum(every - low, 1)
        a = b
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for a in range(0, len(whole), 256):  # few pairs at a time: texts can be long
            batch = whole.slice(a, 256)
            sim = weighted_jaccard(batch.column(2), batch.column(3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(1.0 - sim)], names=["doc", "pivot", "distance"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc, pivot, distance) of pairs (doc, pivot); ``texts`` is (id, text).

    The joins are plain equi-joins, so that Spark splits the partition of a pivot with very many partners.
    """
    a = texts.select(F.col("id").alias("doc"), F.col("text").alias("a"))
    b = texts.select(F.col("id").alias("pivot"), F.col("text").alias("b"))
    # Never broadcast: the size of a table of texts is that of its compressed file to Spark.
    return pairs.join(a.hint("merge"), "doc").join(b.hint("merge"), "pivot").select("doc", "pivot", "a", "b").mapInArrow(_verify, "doc long, pivot long, distance double")


def connected(edges: DataFrame) -> DataFrame:
    """(id, label): smallest id of the connected component of each end of ``edges`` (a, b).

    Each round takes the smallest label among neighbours, then the label's own label, so
    the number of rounds grows with the logarithm of a component's width.
    """
    both = settle(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    label = settle(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(label.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = label.join(near.withColumnRenamed("a", "id"), "id").select("id", "label", F.least("label", "near").alias("next"))
        jump = label.select(F.col("id").alias("next"), F.col("label").alias("jumped"))
        step = step.join(jump, "next", "left").select("id", "label", F.least("next", "jumped").alias("next"))
        step = settle(step, "labels")
        changed = step.where("next <> label").limit(1).count()
        label = step.select("id", F.col("next").alias("label"))
        if not changed:
            return label


def _open_rows(members: DataFrame, label: DataFrame) -> DataFrame:
    """(bucket, id, n, comp) of buckets of several components."""
    rows = members.join(label, "id", "left").select("bucket", "id", "n", F.coalesce("label", F.col("id")).alias("comp"))
    open_ = rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    return settle(rows.join(open_, "bucket"), "open-buckets")


def _few_pairs(rows: DataFrame, small: int) -> DataFrame:
    """Pairs (doc, pivot) of different components in open buckets of up to ``small`` members."""
    few = rows.where(F.col("n") <= small)
    other = few.select("bucket", F.col("id").alias("pivot"), F.col("comp").alias("of"))
    return few.join(other, "bucket").where("comp <> of AND pivot < id").select(F.col("id").alias("doc"), "pivot")


def cross_links(ids: np.ndarray, comp: np.ndarray, block: np.ndarray, texts: pa.Array, near: float) -> list[tuple[int, int]]:
    """Links that join components: of texts of two blocks, or all if there is one block.

    Two texts that end in different components have been compared or differ too much in length.
    """
    names, comp = np.unique(comp, return_inverse=True)
    if len(names) < 2:
        return []
    parts = []
    for a, b, data, offsets in slices(texts, SLICE):
        d, r, c = weighted_runs(data, offsets)
        parts.append((d + a, r, c))
    doc, run, count = (np.concatenate(x) for x in zip(*parts))
    n = len(ids)
    total = np.bincount(doc, weights=count, minlength=n)
    order = np.argsort(total, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    doc = place[doc]
    o = np.argsort(doc, kind="stable")
    doc, run, count = doc[o], np.unique(run, return_inverse=True)[1][o].astype(np.int32), count[o].astype(np.int32)
    ids, comp, block, total = ids[order], comp[order], block[order], total[order]
    at = np.searchsorted(doc, np.arange(n + 1))
    cross = block.min() != block.max()
    sizes = np.bincount(comp)
    main = int(sizes.argmax())
    mine = np.zeros(int(run.max()) + 1, dtype=np.int32)
    least = (1.0 - near) * (1 - 1e-9)
    out = []
    for x in range(n):
        if comp[x] == main:
            continue
        lo, hi = np.searchsorted(total, total[x] * least), np.searchsorted(total, total[x] / least, side="right")
        other = comp[lo:hi] != comp[x]
        if cross:
            other &= block[lo:hi] != block[x]
        if not other.any():
            continue
        s, e = at[lo], at[hi]
        own = slice(at[x], at[x + 1])
        mine[run[own]] = count[own]
        low = np.add.reduceat(np.minimum(count[s:e], mine[run[s:e]]), at[lo:hi] - s)
        mine[run[own]] = 0
        every = total[lo:hi] + total[x]
        for y in lo + np.flatnonzero(other & (1.0 - low / (every - low) <= near)):
            if comp[y] != comp[x]:
                out.append((int(ids[x]), int(ids[y])))
                old, new = (comp[x], comp[y]) if comp[y] == main else (comp[y], comp[x])
                comp[comp == old] = new
    return out


def _many_links(rows: DataFrame, texts: DataFrame, small: int, near: float, block_rows: int, block_bytes: int) -> DataFrame:
    """Links (a, b) between components of open buckets of more than ``small`` members."""
    many = rows.where(F.col("n") > small).join(texts.select("id", "text"), "id")
    sizes = rows.where(F.col("n") > small).join(texts.select("id", F.octet_length("text").alias("size")), "id").groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size"))
    cuts = sizes.select("bucket", F.greatest(F.ceil(F.col("rows") / block_rows), F.ceil(F.col("size") / block_bytes)).cast("int").alias("cuts"))
    many = many.join(cuts, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int"))
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    many = many.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "comp", "block", "text")

    def link(group: pa.Table) -> pa.Table:
        ids, comp, block = (group.column(c).to_numpy() for c in ("id", "comp", "block"))
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        found = cross_links(ids, comp, block, group.column("text").combine_chunks(), near) if i == j or len(np.unique(block)) == 2 else []
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return many.groupBy("bucket", "i", "j").applyInArrow(link, "a long, b long")


def classify(docs: DataFrame, bands: int = 24, rows: int = 5, threshold: float = 0.8, small: int = 16, block_rows: int = 2000, block_bytes: int = 16 << 20) -> DataFrame:
    """(at, digest, alone, class_id, class_size, kept) of every row of ``docs``."""
    near = 1.0 - threshold
    docs = with_key(docs.select("doc_id", "text")).select(F.col("_at").alias("at"), F.col("_digest").alias("digest"), "text")
    sketches = settle(docs.select("at", "text", "digest").mapInArrow(_sketcher(bands, rows), "at long, digest string, bands array<long>"), "sketches")
    # One of each set of equal texts goes on; equal texts have equal bands.
    alike = sketches.where(F.size("bands") > 0).groupBy("digest").agg(F.min("at").alias("at"), F.first("bands").alias("bands"))
    alike = settle(alike.withColumn("id", F.monotonically_increasing_id()), "distinct-texts")
    entries = alike.select("id", F.explode("bands").alias("bucket"))
    crowded = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = settle(entries.join(crowded, "bucket").select("bucket", "id", "n"), "buckets")
    met = members.groupBy("id").agg(F.sum("n").alias("met"))
    asked = alike.select("id", "digest", "at").join(met.select("id"), "id", "left_semi")
    texts = settle(docs.join(asked.hint("merge"), ["at", "digest"]).dropDuplicates(["at", "digest"]).select("id", "text"), "candidates")

    pivots = members.join(met, "id").groupBy("bucket").agg(F.max_by("id", F.struct("met", -F.col("id"))).alias("pivot"))
    pairs = members.join(pivots, "bucket").where("id <> pivot").select(F.greatest("id", "pivot").alias("doc"), F.least("id", "pivot").alias("pivot"))
    tested = settle(verified(pairs.distinct(), texts), "distances")
    links = tested.where(F.col("distance") <= near).select(F.col("doc").alias("a"), F.col("pivot").alias("b"))
    label = connected(links)
    rows_open = _open_rows(members, label)
    pairs = _few_pairs(rows_open, small).distinct().join(tested.select("doc", "pivot"), ["doc", "pivot"], "left_anti")
    fresh = verified(pairs, texts).where(F.col("distance") <= near).select(F.col("doc").alias("a"), F.col("pivot").alias("b"))
    new = settle(fresh.unionByName(_many_links(rows_open, texts, small, near, block_rows, block_bytes)), "more-links")
    if new.limit(1).count():
        label = connected(links.unionByName(new))
    named = alike.join(label, "id", "left").select("digest", F.coalesce("label", "id").alias("class"))
    # Empty texts have no bands and meet no row of ``named``: each stays alone.
    rows_ = sketches.select("at", "digest", (F.size("bands") == 0).alias("alone")).join(named, "digest", "left")
    first = F.min(F.struct((F.col("at") == NO_ID).alias("last"), "at", "digest")).alias("first")
    classes = rows_.where("NOT alone").groupBy("class").agg(first, F.count(F.lit(1)).alias("n"))
    return rows_.join(classes, "class", "left").select(
        "at",
        "digest",
        "alone",
        F.nullif(F.coalesce("first.at", "at"), F.lit(NO_ID)).alias("class_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("class_size"),
        (F.col("alone") | ((F.col("at") == F.col("first.at")) & (F.col("digest") == F.col("first.digest")))).alias("kept"),
    )


def near_classes(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, class_id, class_size, kept) of every row of ``docs``; ``how`` as in classify()."""
    return classify(docs, **how).select(F.nullif("at", F.lit(NO_ID)).alias("doc_id"), "class_id", "class_size", "kept")


def drop_copies(docs: DataFrame, **how) -> DataFrame:
    """One row of each class, with the columns of ``docs``; texts move once more for it."""
    spark = docs.sparkSession
    kept = distil(lambda: classify(docs, **how).where("kept").select(F.col("at").alias("_at"), F.col("digest").alias("_digest"), "alone"), spark, "kept")
    out = with_key(docs).join(kept.hint("merge"), ["_at", "_digest"], "left_semi")
    repeated = kept.where("NOT alone").groupBy("_at", "_digest").count().where("count > 1")
    if repeated.limit(1).count():  # repeated rows of one text: one stays
        empty = ~F.col("text").rlike(r"[^\x20\x09-\x0D]") | F.col("text").isNull()
        out = out.where(~empty).dropDuplicates(["_at", "_digest"]).unionByName(out.where(empty))
    return out.select(*docs.columns)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every row of ``documents``."""
    return near_classes(table(spark, sf_dir, "documents"))
