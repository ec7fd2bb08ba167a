"""Exact Jaccard self-join on word shingles, by T-occurrence search in inverted lists.

``near_duplicates`` gives every row its shingle count and the least id it reaches by links.

* Texts with equal shingle sets collapse into one class before anything is compared.
* Two sets at the threshold must share a token among the first ``n - ceil(t n) + 1`` of each,
  in any one order of tokens. The order here: tokens in the lower part of the hash space by how
  many sets hold them (up to ``OFTEN``), then all others by hash. Tokens of a single set come
  first and link nothing, so a set with enough of them is done without any comparison.
  Classes that share a token among their first ones form a block.
* A block is searched by DivideSkip: a query's longest lists are set aside, the short ones
  are merged into counts, and only candidates that can still reach the overlap are probed
  in the long lists by binary search. A member of the largest component so far needs no
  search of its own: any link to another component is found from the other side.
* A block of more than ``piece_tokens`` shingles is cut. Each piece is searched together with
  one hub of the block; classes not linked to the hub are then searched against every piece,
  in chunks of as many shingles, so no task holds more than one piece and one chunk.

Classes are told apart by their sets' digests; ids are attached at the end. Nulls and empty
texts have no shingles and stay alone. Rows that repeat an id, or have none, are each judged by
their own text; a group of rows without any id has none. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import chosen, components, spread, stored, text_key, text_slices
from tillstar.llm.shingles import shingle_sets

# Part of the hash space whose tokens are counted, and the count above which all are alike.
COUNTED = np.uint64(int(0.4 * 2**64))
OFTEN = 64
# Shingles searched together in one task: beyond that a block is cut.
PIECE_TOKENS = 2_000_000
# Roles of a class in a piece.
MEMBER, HUB, ASKED = 0, 1, 2


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    both = np.frombuffer(blake2b(tokens.tobytes(), digest_size=16).digest(), np.int64)
    return int(both[0]), int(both[1])


def _sets(batches, size: int):
    for batch in batches:
        for low, high, data, offsets in text_slices(batch):
            yield batch, low, high, shingle_sets(data, offsets, size)


def _needed(n: int, percent: int) -> int:
    """How many first tokens a set of ``n`` is found by."""
    return n - -(-percent * n // 100) + 1


def _first(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that may be among the first: the counted ones, and more where those are too few."""
    counted = int(np.searchsorted(tokens, COUNTED))
    return tokens[: max(counted, _needed(len(tokens), percent))]


def _sized(size: int, percent: int):
    names = ("doc_id", "tag", "n_shingles", "node", "check", "spare")
    schema = pa.schema([(c, pa.int64()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, low, high, sets in _sets(batches, size):
            marks = [_digest(s) for s in sets]
            spare = [len(_first(s, percent)) - _needed(len(s), percent) for s in sets]
            columns = [[len(s) for s in sets], *zip(*marks, strict=True), spare]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c)[low:high] for c in names[:2]] + [*[pa.array(c, pa.int64()) for c in columns]],
                schema=schema,
            )

    return run


def _tokens(size: int, percent: int):
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, sets in _sets(batches, size):
            by_node = {_digest(s)[0]: _first(s, percent) for s in sets if len(s)}
            if by_node:
                nodes = np.repeat(np.fromiter(by_node, np.int64), [*map(len, by_node.values())])
                tokens = np.concatenate([*by_node.values()]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens), pa.array(nodes)], schema=schema
                )

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tokens that several nodes hold, with the number of nodes up to ``OFTEN``.

    All rows of a token are in this partition. At most ``OFTEN`` of them are held; further
    ones pass through, as their number is settled.
    """
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("often", pa.int32())])
    token, node = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting, rows = [], 0

    def out(token, node, often):
        columns = [pa.array(token), pa.array(node), pa.array(often, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def merged():
        nonlocal token, node, waiting, rows
        token = np.concatenate([token, *[t for t, _ in waiting]])
        node = np.concatenate([node, *[n for _, n in waiting]])
        waiting, rows = [], 0
        order = np.argsort(token, kind="stable")
        token, node = token[order], node[order]
        first = np.flatnonzero(np.diff(token, prepend=token[:1] - 1))
        count = np.diff(first, append=len(token))
        if int(count.max()) > 1:  # copies of one set in different batches
            order = np.lexsort((node, token))
            token, node = token[order], node[order]
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
            token, node = token[new], node[new]
            first = np.flatnonzero(np.diff(token, prepend=token[:1] - 1))
            count = np.diff(first, append=len(token))
        over = np.arange(len(token)) - np.repeat(first, count) >= OFTEN
        passed = out(token[over], node[over], np.full(int(over.sum()), OFTEN))
        token, node = token[~over], node[~over]
        return passed

    for batch in batches:
        waiting.append((batch.column("token").to_numpy(), batch.column("node").to_numpy()))
        rows += len(batch)
        if rows >= max(500_000, len(token)):
            yield merged()
    if rows:
        yield merged()
    if len(token):
        first = np.flatnonzero(np.diff(token, prepend=token[:1] - 1))
        often = np.repeat(*[np.diff(first, append=len(token))] * 2)
        yield out(token[often > 1], node[often > 1], often[often > 1])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links each node to the first one seen with the same token.

    All rows of a token are in this partition; only one node per token is held, so a token
    that very many nodes share costs no more memory than a rare one.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    known, hub = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting, rows = [], 0

    def merged():
        nonlocal known, hub, waiting, rows
        tokens = np.concatenate([known, *[t for t, _ in waiting]])
        nodes = np.concatenate([hub, *[n for _, n in waiting]])
        order = np.argsort(tokens, kind="stable")
        tokens, nodes = tokens[order], nodes[order]
        first = np.flatnonzero(np.diff(tokens, prepend=tokens[:1] - 1))
        hubs = np.repeat(nodes[first], np.diff(first, append=len(tokens)))
        other = hubs != nodes
        links = np.unique(np.stack([hubs[other], nodes[other]]), axis=1)
        known, hub, waiting, rows = tokens[first], nodes[first], [], 0
        return pa.RecordBatch.from_arrays([pa.array(x) for x in links], schema=schema)

    for batch in batches:
        waiting.append((batch.column("token").to_numpy(), batch.column("node").to_numpy()))
        rows += len(batch)
        if rows >= max(500_000, len(known)):
            yield merged()
    if rows:
        yield merged()


class Search:
    """Inverted lists over the token sets of one block."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sizes = np.array([len(s) for s in sets])
        self.percent = percent
        tokens, group = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.lists = owner[np.argsort(group, kind="stable")]
        self.start = np.searchsorted(np.sort(group), np.arange(len(tokens) + 1))
        self.groups = np.split(group, np.cumsum(self.sizes)[:-1])

    def links(self, query: int) -> np.ndarray:
        """Members whose overlap with ``query`` reaches the threshold, itself included."""
        groups = self.groups[query]
        need = -(-self.percent * len(groups) // 100)
        length = self.start[groups + 1] - self.start[groups]
        order = np.argsort(length, kind="stable")
        longest = int(length[order[-1]])
        long = min(need - 1, int(need / (0.1 * np.log2(longest + 1) + 1)))
        short, far = groups[order[: len(order) - long]], groups[order[len(order) - long :]]
        merged = np.concatenate([self.lists[self.start[g] : self.start[g + 1]] for g in short])
        counts = np.bincount(merged, minlength=len(self.sizes))
        able = np.flatnonzero(counts >= need - long)
        shared = counts[able]
        for g in far:
            own = self.lists[self.start[g] : self.start[g + 1]]
            at = np.minimum(np.searchsorted(own, able), len(own) - 1)
            shared = shared + (own[at] == able)
        union = len(groups) + self.sizes[able] - shared
        return able[100 * shared >= self.percent * union]


def roots(sets: list[np.ndarray], percent: int, asked: np.ndarray | None = None) -> np.ndarray:
    """Component label of each set; with ``asked`` only those are used as queries."""
    label = np.arange(len(sets))
    if len(sets) < 2:
        return label
    search = Search(sets, percent)

    def link(query):
        found = np.unique(label[search.links(query)])
        if len(found) > 1:
            label[np.isin(label, found)] = found[0]

    left = []
    for query in range(len(sets)) if asked is None else asked:
        if asked is None and query and label[query] == np.bincount(label).argmax():
            left.append(query)
        else:
            link(query)
    # What was largest when a query was left out may not be in the end. Only links inside one
    # component may stay unasked.
    main = int(np.bincount(label).argmax())
    for query in left:
        if label[query] != label[main]:
            link(query)
    return label


def _searched(size: int, percent: int):
    """Blocks, sorted by key, to (node, check) of each class, of the least class it is linked
    to, and whether it is apart from the hub."""
    names = ("node", "check", "root_node", "root_check")
    schema = pa.schema([*[(c, pa.int64()) for c in names], ("apart", pa.bool_())])

    def block(held):
        sets = [h[0] for h in held]
        node, check, role = (np.array([h[k] for h in held]) for k in (1, 2, 3))
        asked = np.flatnonzero(role == ASKED) if (role == ASKED).any() else None
        label = roots(sets, percent, asked)
        order = np.lexsort((check, node))
        place, least = np.argsort(order), np.full(len(held), len(held))
        np.minimum.at(least, label, place)
        root = order[least[label]]
        hub = np.isin(label, label[role == HUB])
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (node, check, node[root], check[root], ~hub)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, marks = [], None, set()
        for batch in batches:
            rows = {c: batch.column(c).to_pylist() for c in ("block", "node", "role", "check")}
            for low, high, data, offsets in text_slices(batch):
                for i, tokens in enumerate(shingle_sets(data, offsets, size), low):
                    if rows["block"][i] != current:
                        if held:
                            yield block(held)
                        held, current, marks = [], rows["block"][i], set()
                    mark = _digest(tokens)
                    if len(tokens) and mark not in marks and mark[1] == rows["check"][i]:
                        marks.add(mark)
                        held.append((tokens, rows["node"][i], rows["check"][i], rows["role"][i]))
        if held:
            yield block(held)

    return run


def _search(placed: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Brings each class's text once to each block it is placed in, and searches there.

    The placed classes grow with the input, so this is a merge join at every size.
    """
    same = placed["doc_id"].eqNullSafe(docs["doc_id"]) & (placed["tag"] == docs["tag"])
    rows = placed.hint("merge").join(docs, same).select("block", "node", "role", "check", "text")
    dealt = rows.repartition("block").sortWithinPartitions("block", F.desc("role"), "node", "check")
    return dealt.mapInArrow(
        _searched(size, percent),
        "node long, check long, root_node long, root_check long, apart boolean",
    )


def _edges(links: DataFrame) -> DataFrame:
    root = F.struct(F.col("root_node").alias("node"), F.col("root_check").alias("check"))
    return links.select(F.struct("node", "check").alias("a"), root.alias("b"))


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 75,
    piece_tokens: int = PIECE_TOKENS,
) -> DataFrame:
    """One line per row: doc_id, n_shingles, component_id, class_size."""
    found = grouped(df, id_col, text_col, size, percent, piece_tokens)
    return found.select("doc_id", "n_shingles", "component_id", "class_size")


def grouped(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 75,
    piece_tokens: int = PIECE_TOKENS,
) -> DataFrame:
    """The lines of ``near_duplicates`` with the ``text_key`` of the row's text (tag), and that of
    the group's first row (first_tag): least id, then least key; null if no row has an id."""
    spark = df.sparkSession
    docs = chosen(df, id_col, text_col).withColumn("tag", text_key())
    sized = docs.mapInArrow(
        _sized(size, percent),
        "doc_id long, tag long, n_shingles long, node long, check long, spare long",
    )
    sized = stored(sized, "sets")
    tokens = docs.mapInArrow(_tokens(size, percent), "token long, node long")
    shared = tokens.repartition(spread(spark), "token").mapInArrow(
        _repeated, "token long, node long, often int"
    )
    ranked = shared.groupBy("node").agg(
        F.sort_array(F.collect_set(F.struct("often", "token"))).alias("ranked")
    )
    spare = sized.groupBy("node").agg(F.min("spare").alias("spare"))
    ranked = ranked.join(spare, "node").filter("size(ranked) > spare")
    first = F.expr("slice(ranked, 1, size(ranked) - cast(spare as int))")
    found = ranked.select(F.explode(first).alias("t"), "node").select("t.token", "node")
    stars = found.repartition(spread(spark), "token").mapInArrow(_stars, "a long, b long")
    blocks = stored(components(stars), "blocks")

    classes = sized.filter("n_shingles > 0").groupBy("node", "check").agg(
        # A row to read the text from, and the first row with an id.
        F.min(F.struct("doc_id", "tag")).alias("row"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "tag"))).alias("first"),
        F.min("n_shingles").alias("n_shingles"),
        F.count(F.lit(1)).alias("class_size"),
    )
    classes = stored(classes, "classes")
    members = classes.join(blocks, "node").select("node", "check", "row.*", "n_shingles", "root")
    # Stored, so that the join deals both sides anew and can split the rows of a hot block.
    pieces = stored(_shares(members, "pieces", piece_tokens).filter("pieces > 1"), "pieces")
    members = members.join(pieces, "root", "left")
    members = stored(members.withColumn("pieces", F.coalesce("pieces", F.lit(1))), "members")
    members = members.withColumn("piece", _part("pieces")).withColumn("chunk", F.lit(-1))
    placed = _in_blocks(members, MEMBER)
    cut = members.filter("pieces > 1")
    least = F.min(F.struct("check", "node", "doc_id", "tag", "n_shingles", "pieces", "chunk"))
    hub = cut.groupBy("root").agg(least.alias("h"))
    hubs = _in_blocks(_repeated_over("pieces", hub.select("root", "h.*"), "piece"), HUB)
    links = stored(_search(placed.unionByName(hubs), docs, size, percent), "links")
    found = _edges(links)
    if not cut.isEmpty():
        apart = links.filter("apart").select("node", "check").distinct()
        asked = stored(cut.join(apart, ["node", "check"], "left_semi"), "asked")
        chunks = stored(_shares(asked, "chunks", piece_tokens), "chunks")
        asked = asked.join(chunks, "root").withColumn("chunk", _part("chunks"))
        asked = _in_blocks(_repeated_over("pieces", asked, "piece"), ASKED)
        rest = _in_blocks(_repeated_over("chunks", cut.join(chunks, "root"), "chunk"), MEMBER)
        more = _search(rest.unionByName(asked), docs, size, percent)
        found = found.union(_edges(more))
    joined = components(found).select(F.col("node").alias("own"), F.col("root").alias("group"))
    classes = classes.withColumn("own", F.struct("node", "check")).join(joined, "own", "left")
    classes = classes.withColumn("group", F.coalesce("group", "own"))
    classes = stored(classes.select("node", "check", "class_size", "group", "first"), "grouped")
    # Stored, so that the join deals both sides anew and can split the rows of a hot group.
    first = stored(classes.groupBy("group").agg(F.min("first").alias("first")), "firsts")
    classes = classes.drop("first").join(first, "group").drop("group")
    return sized.join(classes, ["node", "check"], "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce("first.doc_id", "doc_id").alias("component_id"),
        "tag",
        F.col("first.tag").alias("first_tag"),
    )


def _shares(classes: DataFrame, name: str, tokens: int) -> DataFrame:
    """Per block how many parts of about ``tokens`` shingles its classes need."""
    parts = F.ceil(F.sum("n_shingles") / tokens).cast("int")
    return classes.groupBy("root").agg(parts.alias(name))


def _part(parts: str) -> Column:
    return F.pmod(F.xxhash64("check"), F.col(parts).cast("long")).cast("int")


def _repeated_over(parts: str, classes: DataFrame, name: str) -> DataFrame:
    """Every class once for each of the ``parts`` of its block."""
    return classes.withColumn(name, F.explode(F.sequence(F.lit(0), F.col(parts) - 1)))


def _in_blocks(classes: DataFrame, role: int) -> DataFrame:
    """What meets in one task: the classes of a piece, and a chunk of those asked there."""
    block = F.xxhash64("root", "piece", "chunk").alias("block")
    return classes.select("node", "check", "doc_id", "tag", block, F.lit(role).alias("role"))
