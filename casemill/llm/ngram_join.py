"""Jaccard join on word windows, by token-combination prefixes.

A document's tokens are its distinct windows of five words. Two documents link when their tokens' Jaccard similarity is
``LEAST`` percent or more. Equal token sets are one class from the start, so copies are never paired.

Signatures. All tokens have one order: tokens that many documents share come last, the most frequent at the very end;
the others are ordered by hash. A class with n tokens that misses at most t = n - ceil(LEAST n / 100) of them in any
partner takes a prefix of that order. Rare tokens of the prefix are signatures by themselves; of frequent tokens every
two in the prefix are one, and the prefix is longer by one token, so that whatever t tokens are missing either a rare
token or two frequent ones remain. If x's prefix ends before y's, all that x shares within its prefix is in y's, so
linked classes always have a signature in common. As pairs of frequent tokens grow with the square of a prefix, classes
of more than ``MOST_PAIRED`` tokens take all prefix tokens by themselves; those of at least ``LEAST`` percent of that
size take both kinds, and no link crosses the two.

Candidates. The classes of a signature are first compared with the least of them only, which takes as many
comparisons as there are signatures. Components of the links found so far need no comparison inside. What remains, classes
that share a signature and are in different components, is compared in blocks: families of a common least class, or families
merged where that leaves fewer pairs, dealt over tasks of two blocks of near size. No pair is left out, and none is
written unless it links.

Tokens are long, so sketches go first: how many tokens of the class fall in each of about n / 2 slots. Two classes
share at most the sum of the lesser counts; only where that could be enough are the tokens themselves compared. A sketch
folded to ``FOLDED`` bytes is tried before the whole one, so that pairs which a passage brings together cost few bytes.

Signatures are shuffled once. A window over each signature's classes finds the least; where more than ``CROWD`` classes
of one slice of rows share a signature, only the least of these takes part for them. The others are joined with all that
their least was told, once for all signatures they share with it; so no task holds a signature with a large share of the documents.

Which tokens count as frequent is read off all documents (those that several documents of one stretch of the input
share) and bounds the work only: any choice gives the same links. Tokens and classes are 64-bit hashes.

Null and empty texts have no tokens and link with nothing, not even each other. Ids may be null or repeat; every row gets
the component of its own text. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from casemill.llm.components import components
from casemill.llm.keys import bounded
from casemill.llm.shipping import ship
from casemill.llm.words import Words, slices, windows
from casemill.sources.scratch import written

WIDTH, LEAST = 5, 80
#: Classes up to this many tokens pair their frequent tokens.
MOST_PAIRED = 400
#: Share of the documents from which a token is frequent, at least so many, and how many tokens are taken at most:
#: no more than tokens per document / share can be that frequent, 8 bytes each when sent to the executors.
FREQUENT_SHARE, FREQUENT_LEAST, FREQUENT_MOST = 1 / 2000, 16, 1 << 21
#: Tokens of a stretch of the input, and documents of it that must hold a token for it to be counted.
STRETCH, STRETCH_LEAST = 1 << 21, 3
#: Bytes of the first sketch, and classes of one slice that a signature's window takes.
FOLDED, CROWD = 128, 8
#: Classes in a block of the exhaustive comparison.
BLOCK = 256


def _sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct tokens of each text."""
    words = Words(column, fold=True)
    tokens, ends = windows(words.hashes(), words.bounds, WIDTH)
    return [np.unique(tokens[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def _class(tokens: np.ndarray) -> int | None:
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True) if len(tokens) else None


def _signed(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def _sketch(tokens: np.ndarray) -> bytes | None:
    """Tokens in each slot of the lowest bits of their hashes; about half as many slots as tokens, 16 at least."""
    slots = 1 << max(4, int(len(tokens) - 1).bit_length() - 1)
    counts = np.bincount((tokens & np.uint64(slots - 1)).astype(np.int64), minlength=slots)
    return counts.astype(np.uint8).tobytes() if len(tokens) and counts.max() < 256 else None


def _folded(sketch: bytes | None) -> bytes | None:
    """The same counts in at most ``FOLDED`` slots."""
    if sketch is None or len(sketch) <= FOLDED:
        return sketch
    counts = np.frombuffer(sketch, np.uint8).reshape(-1, FOLDED).sum(0, dtype=np.int64)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def _most_shared(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The most tokens that classes with these sketches can share, for one class and the rows of ``many``."""
    if len(one) > many.shape[1]:
        one = one.reshape(-1, many.shape[1]).sum(0)
    if many.shape[1] > len(one):
        many = many.reshape(len(many), -1, len(one)).sum(1)
    return np.minimum(one, many).sum(1)


def classes(documents: DataFrame) -> DataFrame:
    """Rows of two kinds: (``key``, ``n``, ``cls``, ``sketch``, ``fold``) for each document, and (``token``, ``df``) for tokens of several
    classes in one stretch of the input."""
    kind = documents.schema["key"].dataType.simpleString()

    def made(batches):
        key_type, held, seen = None, [], set()

        def flush():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= STRETCH_LEAST
            size = int(often.sum())
            held.clear()
            seen.clear()
            return pa.record_batch({"key": pa.nulls(size, key_type), "n": pa.nulls(size, pa.int64()), "cls": pa.nulls(size, pa.int64()), "sketch": pa.nulls(size, pa.binary()), "fold": pa.nulls(size, pa.binary()), "token": pa.array(_signed(tokens[often])), "df": pa.array(counts[often].astype(np.int64))})

        for rows in slices(batches):
            key_type = rows["key"].type
            sets = _sets(rows["text"])
            names = [_class(s) for s in sets]
            for name, tokens in zip(names, sets):
                if name is not None and name not in seen:
                    seen.add(name)
                    held.append(tokens)
            size = len(rows)
            sketches = [_sketch(s) for s in sets]
            yield pa.record_batch({"key": rows["key"], "n": pa.array([len(s) for s in sets], pa.int64()), "cls": pa.array(names, pa.int64()), "sketch": pa.array(sketches, pa.binary()), "fold": pa.array([_folded(s) for s in sketches], pa.binary()), "token": pa.nulls(size, pa.int64()), "df": pa.nulls(size, pa.int64())})
            if sum(map(len, held)) >= STRETCH:
                yield flush()
        if held:
            yield flush()

    return documents.mapInArrow(made, f"key {kind}, n long, cls long, sketch binary, fold binary, token long, df long")


def frequent_tokens(rows: DataFrame, documents: int) -> np.ndarray:
    """Frequent tokens, the rarest of them first."""
    enough = max(FREQUENT_LEAST, int(documents * FREQUENT_SHARE))
    counted = rows.where("token IS NOT NULL").groupBy("token").agg(F.sum("df").alias("df")).where(F.col("df") >= enough)
    top = counted.orderBy(F.desc("df"), "token").limit(FREQUENT_MOST).toPandas()
    return top["token"].to_numpy(np.int64).view(np.uint64)[::-1]


def prefix_signatures(tokens: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Signatures of one sorted token set; ``frequent``: the frequent tokens sorted, ``rank``: their places in the order."""
    size = len(tokens)
    need = size - -(-LEAST * size // 100) + 1
    at = np.searchsorted(frequent, tokens)
    often = at < len(frequent)
    often[often] = frequent[at[often]] == tokens[often]
    rare, common = tokens[~often], tokens[often][np.argsort(rank[at[often]])]
    out = [rare[:need]]
    if len(rare) < need:
        if size <= MOST_PAIRED:
            taken = common[: need - len(rare) + 1]
            left, right = np.triu_indices(len(taken), 1)
            out.append((taken[left] * np.uint64(0x9E3779B97F4A7C15)) ^ (taken[right] + np.uint64(1)))
        if 100 * size >= LEAST * MOST_PAIRED:
            out.append(common[: need - len(rare)])
    return np.concatenate(out)


def _crowded(sig: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures and classes in order of both, the first row of each signature, and whether its rows are more than ``CROWD``."""
    order = np.lexsort((cls, sig))
    sig, cls = sig[order], cls[order]
    first = np.ones(len(sig), bool)
    first[1:] = sig[1:] != sig[:-1]
    size = np.diff(np.append(np.flatnonzero(first), len(sig)))
    return sig, cls, first, np.repeat(size > CROWD, size)


def signatures(documents: DataFrame, frequent: np.ndarray, crowds: bool) -> DataFrame:
    """(``sig``, ``cls``, ``least``: its signature is crowded in the slice) of all classes; a class occurs once for each slice of
    rows that it is in. Of a crowded signature the least class only. With ``crowds`` (``first``, ``cls``): the others with that least class."""
    order = np.argsort(frequent)
    sent = documents.sparkSession.sparkContext.broadcast((frequent[order], order.astype(np.int64)))  # FREQUENT_MOST at most

    def signed(batches):
        frequent, rank = sent.value
        for rows in slices(batches):
            found = {_class(s): s for s in _sets(rows["text"])}
            found.pop(None, None)
            made = [prefix_signatures(s, frequent, rank) for s in found.values()]
            if made:
                names = np.repeat(np.fromiter(found, np.int64, len(found)), [len(m) for m in made])
                sig, cls, first, crowd = _crowded(_signed(np.concatenate(made)), names)
                if crowds:
                    others = crowd & ~first
                    each = np.unique(np.stack((cls[first][np.cumsum(first) - 1][others], cls[others]), axis=1), axis=0)
                    yield pa.record_batch({"first": pa.array(each[:, 0]), "cls": pa.array(each[:, 1])})
                else:
                    kept = ~crowd | first
                    yield pa.record_batch({"sig": pa.array(sig[kept]), "cls": pa.array(cls[kept]), "least": pa.array(crowd[kept])})

    return documents.select("text").mapInArrow(signed, "first long, cls long" if crowds else "sig long, cls long, least boolean")


def hub_pairs(documents: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(``cls``, ``hub``): every class with the least class of each of its signatures, where that is another; classes of a crowd
    may get some more, that their least class has."""
    least = Window.partitionBy("sig").orderBy("cls").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = signatures(documents, frequent, False).withColumn("hub", F.first("cls").over(least)).where("least OR cls != hub")
    met = written(met, "met")
    crowded = written(met.where("least").select(F.col("cls").alias("first"), "hub").distinct(), "crowded")
    rest = signatures(documents, frequent, True).distinct().join(bounded(crowded), "first").select("cls", "hub")
    return met.select("cls", "hub").unionByName(rest).where("cls != hub").distinct()


def class_sets(documents: DataFrame, wanted: DataFrame, sizes: DataFrame) -> DataFrame:
    """(``cls``, ``n``, ``tokens``) of the classes in ``wanted``, and of some others, worked out again from a document of each."""
    ids = written(sizes.join(wanted, "cls").select("first").distinct(), "first-documents")

    def sets(batches):
        for rows in slices(batches):
            found = {_class(s): s for s in _sets(rows["text"])}
            found.pop(None, None)
            yield pa.record_batch({"cls": pa.array(list(found), pa.int64()), "n": pa.array([len(s) for s in found.values()], pa.int64()), "tokens": pa.array([_signed(s) for s in found.values()], pa.list_(pa.int64()))})

    near = documents.join(bounded(ids), documents["key"].eqNullSafe(ids["first"]), "left_semi")
    return written(near.select("text").mapInArrow(sets, "cls long, n long, tokens array<long>"), "class-sets")


def _linked(shared, left, right):
    return 100 * shared >= LEAST * (left + right - shared)


def _wanted(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``sizes`` for the classes of ``wanted``."""
    return sizes.join(bounded(written(wanted.distinct(), "wanted-classes")), "cls", "left_semi")


def hopeful_pairs(pairs: DataFrame, sizes: DataFrame, column: str) -> DataFrame:
    """The pairs (``cls``, ``hub``) that sizes and the sketches in ``column`` leave open."""

    def filtered(batches):
        for batch in batches:
            n, hub_n = batch["n"].to_numpy(), batch["hub_n"].to_numpy()
            keep = []
            for at, (one, other) in enumerate(zip(batch["sketch"].to_pylist(), batch["hub_sketch"].to_pylist())):
                shared = n[at] if one is None or other is None else _most_shared(np.frombuffer(one, np.uint8).astype(np.int64), np.frombuffer(other, np.uint8).astype(np.int64)[None])[0]
                keep.append(bool(_linked(shared, n[at], hub_n[at])))
            yield batch.select(["cls", "hub"]).filter(pa.array(keep, pa.bool_()))

    # Sizes are compared before the second sketch is fetched: pairs of unlike sizes are shuffled without sketches.
    hubs = sizes.select(F.col("cls").alias("hub"), F.col("n").alias("hub_n"), F.col(column).alias("hub_sketch"))
    sized = pairs.join(sizes.select("cls", "n"), "cls").join(hubs, "hub")
    near = sized.where(LEAST * F.greatest("n", "hub_n") <= 100 * F.least("n", "hub_n"))
    fit = near.join(sizes.select("cls", F.col(column).alias("sketch")), "cls")
    return fit.select("cls", "hub", "n", "hub_n", "sketch", "hub_sketch").mapInArrow(filtered, "cls long, hub long")


def star_links(documents: DataFrame, pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(``a``, ``b``) of the pairs (``cls``, ``hub``) that link."""
    both = lambda pairs: pairs.select("cls").unionByName(pairs.select(F.col("hub").alias("cls")))
    near = written(hopeful_pairs(pairs, sizes, "fold"), "near-pairs")
    open_ = written(hopeful_pairs(near, _wanted(sizes, both(near)), "sketch"), "open-pairs")
    sets = class_sets(documents, both(open_).distinct(), sizes)
    full = open_.join(sets, "cls").join(sets.select(F.col("cls").alias("hub"), F.col("n").alias("hub_n"), F.col("tokens").alias("hub_tokens")), "hub")
    shared = F.size(F.array_intersect("tokens", "hub_tokens"))
    return full.where(_linked(shared, F.col("n"), F.col("hub_n"))).select(F.col("cls").alias("a"), F.col("hub").alias("b"))


def _hopes(n: np.ndarray, label: np.ndarray, side: np.ndarray, sketches: list[bytes | None]) -> np.ndarray:
    """Which classes of a task some class of another component on the other side could link with."""
    hope = np.zeros(len(n), bool)
    widths = [len(x) for x in sketches if x is not None]
    least = min(widths, default=16)
    folded = np.stack([np.zeros(least, np.int32) if x is None else np.frombuffer(x, np.uint8).astype(np.int32).reshape(-1, least).sum(0) for x in sketches])
    known = np.array([x is not None for x in sketches])
    left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
    for at in left:
        near = right[(label[right] != label[at]) & _linked(np.minimum(n[right], n[at]), n[right], n[at])]
        if len(near):
            shared = np.where(known[near] & known[at], np.minimum(folded[at], folded[near]).sum(1), np.minimum(n[at], n[near]))
            hit = near[_linked(shared, n[at], n[near])]
            hope[at] |= len(hit) > 0
            hope[hit] = True
    return hope


def _task_hopes(batches):
    """The rows of ``task``-sorted batches that have hope in their task. Most tasks are small: many of them are judged in one batch."""

    def judged(rows: pa.Table) -> pa.RecordBatch:
        task = rows["task"].to_numpy()
        first = np.flatnonzero(np.concatenate(([True], task[1:] != task[:-1])))
        n, label, side, sketches = rows["n"].to_numpy(), rows["label"].to_numpy(), rows["side"].to_numpy(), rows["sketch"].to_pylist()
        keep = np.zeros(len(task), bool)
        for a, b in zip(first, [*first[1:], len(task)]):
            keep[a:b] = _hopes(n[a:b], label[a:b], side[a:b], sketches[a:b])
        return pa.RecordBatch.from_struct_array(rows.select(["task", "cls", "label", "n", "side"]).filter(pa.array(keep)).to_struct_array().combine_chunks())

    held: list[pa.RecordBatch] = []
    for batch in batches:
        task = batch["task"].to_numpy()
        if not len(task):
            continue
        begin = int(np.flatnonzero(task == task[-1])[0])  # the last task may go on
        if begin:
            held.append(batch.slice(0, begin))
        if held and (begin or held[-1]["task"][0].as_py() != task[-1]):
            yield judged(pa.Table.from_batches(held))
            held = []
        held.append(batch.slice(begin))
    if held:
        yield judged(pa.Table.from_batches(held))


def _block_links(group: pd.DataFrame) -> pd.DataFrame:
    """Links between different components among the classes of a task: a spanning forest of them."""
    group = group.drop_duplicates("cls").reset_index(drop=True)
    left = np.flatnonzero(group["side"].to_numpy() <= 0)
    right = np.flatnonzero(group["side"].to_numpy() >= 0)
    n, label = group["n"].to_numpy(), group["label"].to_numpy()
    tokens = group["tokens"].tolist()
    vocabulary, place = np.unique(np.concatenate(tokens), return_inverse=True)
    owner = np.repeat(np.arange(len(group)), [len(t) for t in tokens])
    common = np.bincount(place) > 1
    number = np.cumsum(common) - 1
    own = common[place]
    place, owner = number[place[own]], owner[own]
    shared = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, int(common.sum()), 4096):
        some = (place >= begin) & (place < begin + 4096)
        holds = np.zeros((len(group), min(4096, int(common.sum()) - begin)), np.float32)
        holds[owner[some], place[some] - begin] = 1
        shared += holds[left] @ holds[right].T
    shared = shared.astype(np.int64)
    hit = _linked(shared, n[left][:, None], n[right][None, :]) & (label[left][:, None] != label[right][None, :])
    root = {x: x for x in set(label.tolist())}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(hit)):
        a, b = find(label[left[i]]), find(label[right[j]])
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((label[left[i]], label[right[j]]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def rest_links(documents: DataFrame, pairs: DataFrame, labels: DataFrame, sizes: DataFrame) -> DataFrame:
    """(``a``, ``b``): labels of components between which the pairs not yet compared have a link."""
    named = pairs.join(labels.select(F.col("node").alias("cls"), "label"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    open_ = named.groupBy("hub").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("m")).where("x != y").select("hub", "m")
    named = written(named.join(open_, "hub"), "families")
    merged = components(named.select(F.col("cls").alias("a"), F.col("hub").alias("b")))
    named = named.join(merged.select(F.col("node").alias("hub"), F.col("label").alias("family")), "hub")
    apart = named.groupBy("family", "hub").agg(F.count("*").cast("double").alias("m")).groupBy("family").agg(F.sum(F.col("m") * F.col("m")).alias("apart"))
    together = named.select("family", "cls").distinct().groupBy("family").agg(F.count("*").cast("double").alias("m"))
    joint = apart.join(together, "family").where("m * m <= apart").select("family", F.lit(True).alias("joint"))
    named = named.join(joint, "family", "left").withColumn("task", F.when(F.col("joint"), F.struct(F.lit(1).alias("k"), F.col("family").alias("id"))).otherwise(F.struct(F.lit(0).alias("k"), F.col("hub").alias("id"))))
    # Size steps are such that linked classes are in the same or the next one.
    step = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / LEAST)) + 1e-9).cast("int")
    members = written(named.select("task", "cls", "label").distinct().join(sizes.select("cls", "n"), "cls").withColumn("step", step), "members")
    steps = members.groupBy("task", "step").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    steps = steps.groupBy("task").agg(F.map_from_entries(F.collect_list(F.struct("step", "blocks"))).alias("blocks"))  # an entry per size step
    steps = bounded(written(steps, "steps"))
    count = lambda at: F.coalesce(F.col("blocks")[at], F.lit(0))
    members = members.join(steps, "task").withColumn("block", F.pmod(F.xxhash64("cls"), count(F.col("step"))).cast("int"))
    part = lambda low, i, high, j, side: F.struct(low.alias("low"), i.alias("i"), high.alias("high"), j.alias("j"), side.cast("int").alias("side"))
    upto = lambda size: F.filter(F.sequence(F.lit(0), F.greatest(size, F.lit(1)) - 1), lambda k: k < size)
    own, block = F.col("step"), F.col("block")
    tasks = F.concat(
        F.transform(upto(count(own)), lambda k: part(own, F.least(block, k), own, F.greatest(block, k), F.when(k > block, -1).when(k < block, 1).otherwise(0))),
        F.transform(upto(count(own + 1)), lambda k: part(own, block, own + 1, k, F.lit(-1))),
        F.transform(upto(count(own - 1)), lambda k: part(own - 1, k, own, block, F.lit(1))),
    )
    dealt = members.select("task", "cls", "label", "n", F.inline(tasks))
    dealt = dealt.select(F.xxhash64("task", "low", "i", "high", "j").alias("task"), "cls", "label", "n", "side")
    mixed = dealt.groupBy("task").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.min("side").alias("from"), F.max("side").alias("to"))
    mixed = mixed.where("x != y AND from <= 0 AND to >= 0").select("task")
    dealt = dealt.join(mixed, "task")
    for column, purpose in (("fold", "near-hopes"), ("sketch", "hopes")):
        own = sizes if column == "fold" else _wanted(sizes, dealt.select("cls"))
        dealt = dealt.join(own.select("cls", F.col(column).alias("sketch")), "cls").repartition("task").sortWithinPartitions("task")
        dealt = written(dealt.mapInArrow(_task_hopes, "task long, cls long, label long, n long, side int"), purpose)
    sets = class_sets(documents, dealt.select("cls").distinct(), sizes)
    return dealt.join(sets.select("cls", "tokens"), "cls").groupBy("task").applyInPandas(_block_links, "a long, b long")


def joined(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``n_shingles``, ``component_id``."""
    found = _classed(documents.select(documents[key].alias("key"), documents[text].alias("text")))
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component_id"))


def _classed(rows: DataFrame) -> DataFrame:
    """(``key``, ``n``, ``cls``, ``component``: least key of the linked classes) for each of ``rows`` (``key``, ``text``)."""
    ship(rows.sparkSession)
    both = written(classes(rows), "classes")
    docs = both.where("n IS NOT NULL").select("key", "n", "cls")
    frequent = frequent_tokens(both, docs.count())
    sizes = both.where("cls IS NOT NULL").groupBy("cls").agg(F.min("key").alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("fold").alias("fold"))
    sizes = written(sizes, "class-sizes")

    pairs = written(hub_pairs(rows, frequent), "pairs")

    star = components(written(star_links(rows, pairs, sizes), "links"))
    rest = written(rest_links(rows, pairs, star, sizes), "more-links")
    final = components(rest).select(F.col("node").alias("label"), F.col("label").alias("last"))
    label = star.join(final, "label", "full").select(F.coalesce("node", "label").alias("cls"), F.coalesce("last", "label").alias("label"))
    label = written(label, "class-labels")

    named = sizes.join(label, "cls", "left").select("cls", "first", F.coalesce("label", "cls").alias("label"))
    least = named.groupBy("label").agg(F.min("first").alias("component"))
    named = written(named.join(least, "label").select("cls", "component"), "class-components")
    return docs.join(named, "cls", "left")


def representatives(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of linked documents, that of the least key, with all its columns; of rows that repeat a
    key and its tokens, one. Documents without words all stay."""
    found = written(_classed(documents.select(documents[key].alias("key"), documents[text].alias("text"))).where("cls IS NOT NULL"), "components")
    gone = found.where(~F.col("key").eqNullSafe(F.col("component"))).select("key", "cls").distinct()
    again = found.groupBy("key", "cls").agg(F.count("*").alias("n")).where("n > 1").select("key", "cls")

    def named(batches):
        for rows in slices(batches):
            yield pa.record_batch({"_row": rows["_row"], "_cls": pa.array([_class(s) for s in _sets(rows["text"])], pa.int64())})

    packed = documents.select(F.struct("*").alias("_row"), documents[text].alias("text"))
    rows = packed.mapInArrow(named, StructType([packed.schema["_row"], StructField("_cls", LongType())]))
    match = lambda keys: F.col(f"_row.{key}").eqNullSafe(keys["key"]) & (F.col("_cls") == keys["cls"])
    gone = written(gone, "linked-away")
    rows = rows.join(bounded(gone), match(gone), "left_anti")
    again = written(again, "repeated")
    if again.limit(1).count():
        rows = rows.withColumn("_key", F.col(f"_row.{key}"))
        once = rows.join(bounded(again), match(again), "left_semi").dropDuplicates(["_key", "_cls"])
        rows = rows.join(bounded(again), match(again), "left_anti").unionByName(once)
    return rows.select("_row.*")
