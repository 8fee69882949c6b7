"""Conversation prefix trie, built as a burst trie over Spark partitions.

A turn is known by the md5 of its role and text, a conversation by the sequence
of its turns. Sequences are cut into pieces of ``CHUNK`` turns; the trie node at
which a piece begins is its head, known by the running sum of the hashes of the
pieces before it. All pieces are containers' entries at once, whatever their
depth, so the longest conversation sets neither a task's memory nor the number
of rounds. Equal pieces under one head are one entry with a count: exact copies
meet in a map-side aggregate.

A container with more than ``MOST`` entries bursts: its entries move to the
containers of their next turn's id, at most ``CHUNK`` times. The containers left
are dealt over the partitions, sorted, and swept into nodes with a stack of open
nodes. Burst nodes get their sums from the heads of the containers below, and
sums of deeper pieces come by pointer doubling over the heads (log2 of the depth
in pieces), then are added to the at most ``CHUNK`` nodes above a head.

A node's digest is SHA-256, a sequential function: its members' ids are joined
in spans of 2^``SPAN`` numbers and streamed in order through one hash state, so a
node with a third of all conversations needs one task's time but no memory.

Defined cases: null conv_id takes no part; null role or text is empty; turns are
ordered by turn (null first), then by their md5; equal rows are turns of their
own; a conversation of any length is split; an empty table gives an empty
result, otherwise there is a root; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.llm.shared import cut, n_words
from veracity.operators import ordered

CHUNK, MOST = 64, 4096
SPAN = 9  # bits: ids that share all but these are one string of a digest
BASE, HEADS = 20, 4
ROOT = "0:0:0"
ID = 32  # hexadecimal digits of a turn's id
_HASH = "decimal(20,0)"
NODE = ("node string, up string, low long, depth long, parent_low long, n long, children long, leaves long, saved long, sha string, "
        "head string, j long, level int, path string, words array<long>, head_low long")


def _node(head: Column, path: Column) -> Column:
    return F.md5(F.concat(head, F.lit("|"), path))


def _piece_hash(ids: Column, j: Column, half: int) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", ids, j)), 1 + 16 * half, 15), 16, 10).cast(_HASH)


def _head(j: Column, a: Column, b: Column) -> Column:
    return F.concat_ws(":", j.cast("string"), a.cast("decimal(38,0)").cast("string"), b.cast("decimal(38,0)").cast("string"))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), tid, words of every turn in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    own = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("tid"), n_words(text).alias("words"))
    return ordered.group_rank(own, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("tid")], "pos")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations with their number of rebuilt turns, rebuilt turns conv_id, pos, tid, words)."""
    convs = (turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
             .withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE)
             .withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")))
    turn = F.struct("pos", "tid", "words")
    # at most three turns a base, and at most twenty conversations
    first = (turns.filter((F.col("pos") < HEADS - 1) & (F.col("conv_id") % BASE == 0)).groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(turn)).alias("first")))
    none = F.array().cast("array<struct<pos:bigint,tid:string,words:bigint>>")
    convs = (convs.join(first, "base", "left").withColumn("first", F.slice(F.coalesce("first", none), F.lit(1), F.col("h")))
             .withColumn("total", F.size("first") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
             .withColumn("shift", F.size("first") - F.col("h")))
    convs = cut(convs.select("conv_id", "h", "first", "total", "shift"))
    begin = convs.select("conv_id", F.explode("first").alias("t")).select("conv_id", "t.pos", "t.tid", "t.words")
    rest = (turns.join(convs.select("conv_id", "h", "shift"), "conv_id").filter("pos >= h")
            .select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "tid", "words"))
    return convs.select("conv_id", "total"), begin.union(rest)


def pieces(convs: DataFrame, turns: DataFrame, chunk: int) -> DataFrame:
    """conv_id, j, a, b (hash sums of the pieces before), ids, words, ends (the conversation ends here)."""
    held = turns.groupBy("conv_id", F.floor(F.col("pos") / chunk).alias("j")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "tid", "words"))).alias("t"))
    held = held.join(convs, "conv_id").select(
        "conv_id", "j", F.array_join("t.tid", "").alias("ids"), F.col("t.words").alias("words"),
        (F.col("total") <= (F.col("j") + 1) * chunk).alias("ends"), (F.col("total") > chunk).alias("long"))
    zero = F.lit(0).cast("decimal(38,0)")
    short = held.filter("NOT long").select("conv_id", "j", zero.alias("a"), zero.alias("b"), "ids", "words", "ends")
    parts = held.filter("long").select("*", _piece_hash(F.col("ids"), F.col("j"), 0).alias("ha"),
                                       _piece_hash(F.col("ids"), F.col("j"), 1).alias("hb"))
    sums = ordered.running_sums(parts, ["conv_id"], [F.col("j")], ["ha", "hb"], F.floor(F.col("j") / 1024))
    before = sums.select("conv_id", "j", (F.col("cum_ha") - F.col("ha")).cast("decimal(38,0)").alias("a"),
                         (F.col("cum_hb") - F.col("hb")).cast("decimal(38,0)").alias("b"), "ids", "words", "ends")
    return short.unionByName(before)


def end_digests(ends: DataFrame) -> DataFrame:
    """sha of the ids (node, conv_id) that end at a node: ascending, comma-joined."""
    spans = (ends.groupBy("node", F.shiftright("conv_id", SPAN).alias("span"))
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))

    def run(batches):
        now, state = None, None
        for batch in batches:
            nodes, shas = [], []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if node != now:
                    if now is not None:
                        nodes.append(now)
                        shas.append(state.hexdigest())
                    now, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_buffer())
            yield pa.record_batch([pa.array(nodes, pa.string()), pa.array(shas, pa.string())], names=["node", "sha"])
        if now is not None:
            yield pa.record_batch([pa.array([now]), pa.array([state.hexdigest()])], names=["node", "sha"])

    return (spans.repartition("node").sortWithinPartitions("node", "span").select("node", "ids")
            .mapInArrow(run, "node string, sha string"))


def burst(entries: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(entries in containers of at most ``most``, entries that end at a burst node), with ``level`` and ``path`` of the
    container: how many turns its path adds to the head."""
    left, stubs, live, level = None, None, entries, 0
    while True:
        placed = live.withColumn("level", F.lit(level)).withColumn("path", F.substring("ids", 1, ID * level))
        big = cut(placed.groupBy("head", "path").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select("head", "path"))
        if big.isEmpty():
            return (placed if left is None else left.unionByName(placed)), stubs
        stay = placed.join(big, ["head", "path"], "left_anti")
        left = stay if left is None else left.unionByName(stay)
        go = cut(placed.join(big, ["head", "path"], "left_semi"))
        ended = go.filter(F.length("ids") == ID * level)
        stubs = ended if stubs is None else stubs.unionByName(ended)
        live, level = go.filter(F.length("ids") > ID * level).drop("level", "path"), level + 1


class _Open:
    """A trie node whose members are still being swept."""

    __slots__ = ("low", "n", "children", "leaves", "saved", "sha", "more", "words", "under")

    def __init__(self, words: int):
        self.low, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.sha, self.more, self.words, self.under = None, False, words, []


def _sweep(chunk: int):
    """Sorted entries (head, level, path, ids, j, n, low, words, sha, more, head_low) to nodes, a container at a time."""
    fields = NODE.split(", ")
    names = [f.split()[0] for f in fields]
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "array<long>": pa.list_(pa.int64())}
    types = [kinds[f.split()[1]] for f in fields]

    def container(head, level, entries, rows):
        base = max(level, 1)
        top = _Open(0)
        stack: list[_Open] = [top]  # stack[i] is open at level base - 1 + i
        before = ""
        ids, head_low, j = "", None, 0

        def close(ids: str):
            depth = base + len(stack) - 2
            node = stack.pop()
            if not node.children and not node.more:
                node.leaves = 1
            node.saved += (node.n - 1) * node.words
            up = stack[-1]
            up.low = node.low if up.low is None else min(up.low, node.low)
            up.n += node.n
            up.children += 1
            up.leaves += node.leaves
            up.saved += node.saved
            path = ids[: ID * depth]
            me = hashlib.md5(f"{head}|{path}".encode()).hexdigest()
            is_head = level > 0 and depth == level
            up.under.append([me, None, node.low, j * chunk + depth, None, node.n, node.children, node.leaves, node.saved, node.sha,
                             head, j, depth, path if is_head else None, None, head_low])
            for row in node.under:
                row[4] = node.low
            rows.extend(node.under)

        first_words = None
        for ids, j, n, low, words, sha, more, head_low in entries:
            if first_words is None:
                first_words = words
            length = len(ids) // ID
            shared = base - 1
            if before:
                while shared < length and ids[ID * shared: ID * shared + ID] == before[ID * shared: ID * shared + ID]:
                    shared += 1
                shared = min(shared, len(before) // ID)
            while len(stack) > shared - base + 2:
                close(before)
            while base + len(stack) - 2 < length:
                stack.append(_Open(words[base + len(stack) - 2]))
            end = stack[-1]
            end.n += n
            end.low = low if end.low is None else min(end.low, low)
            end.sha, end.more = sha, more
            before = ids
        while len(stack) > 1:
            close(before)
        for row in top.under:
            if base == 1:
                row[4] = head_low
            else:
                row[1] = hashlib.md5(f"{head}|{row[13][:-ID]}".encode()).hexdigest()
            if row[13] is not None:
                row[14] = first_words[:level]
        rows.extend(top.under)

    def run(batches):
        rows, now, held = [], None, []

        def out():
            batch = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(names), types)], names=names)
            rows.clear()
            return batch

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256).to_pydict()
                for key, *entry in zip(zip(part["head"], part["level"], part["path"]), part["ids"], part["j"], part["n"], part["low"],
                                       part["words"], part["sha"], part["more"], part["head_low"]):
                    if key != now:
                        if held:
                            container(now[0], now[1], held, rows)
                        now, held = key, []
                        if len(rows) > 10_000:
                            yield out()
                    held.append(entry)
        if held:
            container(now[0], now[1], held, rows)
        yield out()
    return run


def _burst_nodes(swept: DataFrame, stubs: DataFrame, chunk: int) -> DataFrame:
    """Nodes of burst containers, from the heads of the containers below and the entries that end at them."""
    some = ["head", "j", "path", "n", "low", "leaves", "saved", "words", "head_low"]
    heads = swept.filter("path IS NOT NULL").select(*some, F.lit(None).cast("string").alias("sha"), F.lit(False).alias("stub"))
    zero = F.lit(0).cast("long")
    ended = stubs.select("head", "j", F.col("ids").alias("path"), "n", "low", zero.alias("leaves"), zero.alias("saved"), "words",
                         "head_low", "sha", F.lit(True).alias("stub"))
    size = (F.length("path") / ID).cast("int")
    wide = (heads.unionByName(ended).withColumn("_size", size)
            .withColumn("_most", F.col("_size") - F.when(F.col("stub"), 0).otherwise(1)).filter("_most > 0")
            .withColumn("level", F.explode(F.sequence(F.lit(1), F.col("_most")))))
    prefix = F.col("path").substr(F.lit(1), F.col("level") * ID)
    following = F.when(F.col("_size") > F.col("level"), F.col("path").substr(F.col("level") * ID + 1, F.lit(ID)))
    nodes = cut(wide.groupBy("head", "j", "head_low", "level", prefix.alias("path")).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.max(F.when(F.col("stub") & (F.col("_size") == F.col("level")), F.col("sha"))).alias("sha"),
        F.count_distinct(following).alias("children"),
        F.first(F.element_at("words", F.col("level"))).alias("last")))
    own = (nodes.withColumn("up", F.explode(F.sequence(F.lit(1), F.col("level"))))
           .groupBy("head", F.col("path").substr(F.lit(1), F.col("up") * ID).alias("path"))
           .agg(F.sum((F.col("n") - 1) * F.col("last")).alias("inner")))
    nodes = nodes.join(own, ["head", "path"]).withColumn("saved", F.col("saved") + F.col("inner"))
    above = F.col("path").substr(F.lit(1), (F.col("level") - 1) * ID)
    return nodes.select(
        _node(F.col("head"), F.col("path")).alias("node"), F.when(F.col("level") > 1, _node(F.col("head"), above)).alias("up"), "low",
        (F.col("j") * chunk + F.col("level")).alias("depth"), F.when(F.col("level") == 1, F.col("head_low")).alias("parent_low"),
        "n", "children", "leaves", "saved", "sha", "head", "j", "level", "path", F.lit(None).cast("array<long>").alias("words"), "head_low")


def _hang(nodes: DataFrame, links: DataFrame, chunk: int) -> DataFrame:
    """Nodes with the sums of the pieces that hang below them; links: head, parent head and ids of the piece above."""
    own = (nodes.filter((F.col("level") == 1) & (F.col("j") > 0)).groupBy("head")
           .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count(F.lit(1)).alias("kids"), F.max("j").alias("j")))
    state = cut(own.join(links, "head").select(
        "head", F.when(F.col("j") > 1, F.col("above")).alias("jump"), "leaves", "saved", "kids", "j", "above", "ids"))
    deepest = state.agg(F.max("j")).first()[0] or 1
    for _ in range(math.ceil(math.log2(deepest))):
        add = (state.filter("jump IS NOT NULL").groupBy(F.col("jump").alias("head"))
               .agg(F.sum("leaves").alias("_l"), F.sum("saved").alias("_s")))
        ahead = state.select(F.col("head").alias("jump"), F.col("jump").alias("_jump"))
        state = cut(state.join(add, "head", "left").join(ahead, "jump", "left").select(
            "head", F.col("_jump").alias("jump"), (F.col("leaves") + F.coalesce("_l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("_s", F.lit(0))).alias("saved"), "kids", "j", "above", "ids"))
    hung = (state.withColumn("at", F.explode(F.sequence(F.lit(1), F.lit(chunk))))
            .groupBy(_node(F.col("above"), F.col("ids").substr(F.lit(1), F.col("at") * ID)).alias("node"))
            .agg(F.sum("leaves").alias("_l"), F.sum("saved").alias("_s"),
                 F.sum(F.when(F.col("at") == chunk, F.col("kids")).otherwise(0)).alias("_c")))
    zero = F.lit(0)
    return nodes.join(hung, "node", "left").withColumns({
        "leaves": F.col("leaves") + F.coalesce("_l", zero), "saved": F.col("saved") + F.coalesce("_s", zero),
        "children": F.col("children") + F.coalesce("_c", zero)}).drop("_l", "_s", "_c")


def trie(conversations: DataFrame, chunk: int = CHUNK, most: int = MOST) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    convs, turns = rebuilt(numbered_turns(conversations))
    parts = cut(pieces(convs, turns, chunk))
    all_convs = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low")).first()
    entries = (parts.groupBy("j", "a", "b", "ids").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), F.count_if("ends").alias("ended"), F.first("words").alias("words"))
        .withColumn("head", _head(F.col("j"), F.col("a"), F.col("b"))).withColumn("more", F.col("n") > F.col("ended")))
    ends = parts.filter("ends").select(_node(_head(F.col("j"), F.col("a"), F.col("b")), F.col("ids")).alias("node"), "conv_id")
    silent = convs.filter("total = 0").select(F.lit(ROOT).alias("node"), "conv_id")
    shas = cut(end_digests(ends.union(silent)))
    entries = cut(entries.withColumn("node", _node(F.col("head"), F.col("ids"))).join(shas, "node", "left"))
    links = entries.filter("more").select(
        _head(F.col("j") + 1, F.col("a") + _piece_hash(F.col("ids"), F.col("j"), 0),
              F.col("b") + _piece_hash(F.col("ids"), F.col("j"), 1)).alias("head"), F.col("head").alias("above"), "ids", "low")
    own = ["head", "j", "ids", "n", "low", "words", "sha", "more"]
    top = entries.filter("j = 0").select(*own, F.lit(all_convs["low"]).cast("long").alias("head_low"))
    deep = entries.filter("j > 0").select(*own).join(links.select("head", F.col("low").alias("head_low")), "head")
    placed, stubs = burst(top.unionByName(deep), most)
    swept = (placed.repartition("head", "path").sortWithinPartitions("head", "level", "path", "ids")
             .select("head", "level", "path", "ids", "j", "n", "low", "words", "sha", "more", "head_low").mapInArrow(_sweep(chunk), NODE))
    nodes = cut(swept)
    if stubs is not None:
        inner = cut(_burst_nodes(nodes, stubs, chunk))
        under = nodes.unionByName(inner)
        lows = inner.select(F.col("node").alias("up"), F.col("low").alias("_low"))
        nodes = under.join(lows, "up", "left").withColumn("parent_low", F.coalesce("parent_low", "_low")).drop("_low")
    if not links.isEmpty():
        nodes = _hang(cut(nodes), links.drop("low"), chunk)
    nodes = cut(nodes.select("low", "depth", "parent_low", "n", "children", "leaves", "saved", "sha"))
    root = nodes.filter("depth = 1").agg(F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    said = shas.filter(F.col("node") == ROOT).first()
    root = root.select(
        F.lit(all_convs["low"]).cast("long").alias("low"), zero.alias("depth"), none.alias("parent_low"),
        F.lit(all_convs["n"]).cast("long").alias("n"), "children", F.greatest(F.coalesce("leaves", zero), F.lit(1)).alias("leaves"),
        F.coalesce("saved", zero).alias("saved"), F.lit(said["sha"] if said else None).cast("string").alias("sha")).filter("n > 0")
    empty = hashlib.sha256().hexdigest()
    return nodes.unionByName(root).select(
        F.col("low").alias("conv_id"), "depth", F.col("parent_low").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(empty)).alias("ends_sha256"))
