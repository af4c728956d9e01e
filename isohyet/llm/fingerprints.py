"""Document fingerprints that can be subtracted: invertible Bloom lookup tables of paragraph digests.

A paragraph is a line, or a sentence of a line.  A fingerprint has blocks of cells; a digest belongs to one block by its
hash and goes to three cells of it.  A cell has the count, the exclusive-or of digests and that of their check hashes.
Equal texts have equal fingerprints.  Of two versions the cells are subtracted, and peeling recovers the digests that
differ, each with its side: a cell with one digest gives it away, it is taken from its other cells, and so on.  A block
that does not peel empty is tried again in a larger table: its digests are dealt to two blocks by a bit of their check
hash, and so on for each block that does not peel.  A block with one digest always peels, so no sets are compared.  The
likeness of two fingerprints is the share of their different digests that both have (1 for two without).

All of it is SQL: each text is shuffled once, to the documents around it in the order of ids, and the rest happens where
it lies.  Null texts count as empty.  The next document of the one with the smallest id is that with the largest; of
rows that share an id, the next is another of them (by hash of the text).  Rows without id come last in this order.  An
empty table gives no rows.  Rows equal in id and text are together in one task, however many; any others are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: Blocks of a fingerprint, and width of each of the three ranges of cells of a block.
BLOCKS, WIDTH = 4, 4
#: Digests of two blocks above which a table as large as a block's is not tried, but twice as large a one.
CROWD = 32
#: Documents in one group of neighbours, about; above SPLITS ** LEVELS groups these grow instead.
GROUP = 2000
SPLITS, LEVELS = 64, 3
LEAST_ID = -(1 << 63)


def let(value: str, name: str, body: str) -> str:
    """SQL of body, in which name stands for value, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def digests(text: str) -> str:
    """SQL of the different paragraph digests of a text, in order of their blocks (b), with their cells."""
    parts = f"array_distinct(transform(filter(split({text}, '\\n+|(?<=[.!?])[ \\t]+'), x -> trim(x) <> ''), x -> xxhash64(x)))"
    block = f"'b', cast(pmod(h, {BLOCKS}) as int), "
    return f"array_sort(transform({parts}, h -> {item('h', 'xxhash64(h)', str(WIDTH), block)}))"


def item(h: str, check: str, width: str, more: str = "") -> str:
    places = [f"{j} * {width} + cast(pmod(shiftright({h}, {4 + 19 * j}), {width}) as int)" for j in range(3)]
    return f"named_struct({more}'k', {h}, 'c', {check}, 'p', {places[0]}, 'q', {places[1]}, 'r', {places[2]})"


def cells(items: str, width: str) -> str:
    zero = "named_struct('n', 0, 'k', 0L, 'c', 0L)"
    add = "(a, u) -> named_struct('n', a.n + 1, 'k', a.k ^ u.k, 'c', a.c ^ u.c)"
    return f"transform(sequence(0, 3 * {width} - 1), i -> aggregate(filter({items}, u -> u.p = i or u.q = i or u.r = i), {zero}, {add}))"


def sketch(items: str) -> str:
    """SQL of the blocks of a fingerprint: their digests and cells.  items are in order of blocks."""
    own = "case when s = 0 then slice(all, 1, 0) else slice(all, cast(s as int), cast(size(all) + 2 - s - array_position(back, g) as int)) end"
    block = let(let("array_position(codes, g)", "s", own), "own", f"named_struct('items', own, 'cells', {cells('own', str(WIDTH))})")
    blocks = f"transform(sequence(0, {BLOCKS - 1}), g -> {block})"
    return let(items, "all", let("transform(all, u -> u.b)", "codes", let("reverse(codes)", "back", blocks)))


NONE = "cast(array() as array<bigint>)"


def peeled(diff: str, rounds: int) -> str:
    """SQL of what is left of the cells of a difference, and of the digests found on either side."""
    pure = f"array_distinct(transform(filter(s.cells, x -> abs(x.n) = 1 and x.c = xxhash64(x.k)), x -> {item('x.k', 'x.c', str(WIDTH), chr(39) + 'n' + chr(39) + ', x.n, ')}))"
    taken = "aggregate(filter(pure, u -> u.p = i or u.q = i or u.r = i), x, (a, u) -> named_struct('n', a.n - u.n, 'k', a.k ^ u.k, 'c', a.c ^ u.c))"
    found = lambda n: f"transform(filter(pure, u -> u.n = {n}), u -> u.k)"
    step = f"case when size(pure) = 0 then s else named_struct('cells', transform(s.cells, (x, i) -> {taken}), 'one', concat(s.one, {found(1)}), 'two', concat(s.two, {found(-1)})) end"
    return f"aggregate(sequence(1, {rounds}), named_struct('cells', {diff}, 'one', {NONE}, 'two', {NONE}), (s, round) -> {let(pure, 'pure', step)})"


def minus(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'c', x.c ^ y.c))"


def larger(a: str, b: str) -> str:
    """SQL of the digests in which two lists of items differ, by tables that grow until all of their blocks peel."""
    bit = lambda g, i, v: f"filter({g}, u -> (shiftright(u.c, {i}) & 1) = {v})"
    halves = lambda a, b, i: f"array({', '.join(f'named_struct({chr(39)}a{chr(39)}, {bit(a, i, v)}, {chr(39)}b{chr(39)}, {bit(b, i, v)})' for v in (0, 1))})"
    tried = peeled(minus(cells("g.a", str(WIDTH)), cells("g.b", str(WIDTH))), 6)
    done = "named_struct('a', slice(g.a, 1, 0), 'b', slice(g.b, 1, 0), 'one', t.one, 'two', t.two)"
    open_ = f"named_struct('a', g.a, 'b', g.b, 'one', {NONE}, 'two', {NONE})"
    attempt = f"case when size(g.a) + size(g.b) > {CROWD} then {open_} else {let(tried, 't', f'case when exists(t.cells, x -> x.n <> 0 or x.k <> 0) then {open_} else {done} end')} end"
    left = f"flatten(transform(filter(tried, g -> size(g.a) + size(g.b) > 0), g -> {halves('g.a', 'g.b', 'bit')}))"
    step = let(f"transform(w.rest, g -> {attempt})", "tried", f"named_struct('rest', {left}, 'one', concat(w.one, flatten(transform(tried, g -> g.one))), 'two', concat(w.two, flatten(transform(tried, g -> g.two))))")
    start = f"named_struct('rest', {halves(a, b, '0')}, 'one', {NONE}, 'two', {NONE})"
    # after the last bit each block has one digest
    return f"aggregate(sequence(1, 64), {start}, (w, bit) -> case when size(w.rest) = 0 then w else {step} end, w -> named_struct('one', w.one, 'two', w.two))"


def differing(a: str, b: str) -> str:
    """SQL of the digests of either of two blocks that the other has not: one, two."""
    left = "exists(f.cells, x -> x.n <> 0 or x.k <> 0)"
    first = let(peeled(minus(f"{a}.cells", f"{b}.cells"), 4), "f", f"case when {left} then {larger(f'{a}.items', f'{b}.items')} else named_struct('one', f.one, 'two', f.two) end")
    return f"case when {a}.cells = {b}.cells then named_struct('one', {NONE}, 'two', {NONE}) else {first} end"


def difference(a: str, b: str) -> str:
    """SQL of the digests in which two sketches differ, by side: one has those of the first, two those of the second."""
    sides = (f"'{side}', flatten(transform(d, x -> x.{side}))" for side in ("one", "two"))
    return let(f"zip_with({a}, {b}, (own, other) -> {differing('own', 'other')})", "d", f"named_struct({', '.join(sides)})")


def likeness(a: str, b: str, diff: str) -> str:
    """SQL of the likeness of two sketches, from their difference."""
    size = lambda s: f"aggregate({s}, 0, (s, x) -> s + size(x.items))"
    total = f"{size(a)} + {size(b)}"
    return let(f"size({diff}.one) + size({diff}.two)", "d", let(total, "n", "case when n = 0 then 1.0D else cast(n - d as double) / (n + d) end"))


def as_string(s: str) -> str:
    cell = "case when x.n = 0 and x.k = 0 then '.' else concat(hex(x.n), ':', hex(x.k), ':', hex(x.c), ';') end"
    return f"array_join(flatten(transform({s}, b -> transform(b.cells, x -> {cell}))), '')"


def neighbours(docs: DataFrame, **columns: str) -> DataFrame:
    """docs(doc_id, text) with next_text, that of the next document in descending order of doc_id.

    columns: SQL of further columns of a document, by name; next_<name> is the next document's.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)), "_tie": F.xxhash64("text"), "_group": F.lit(0).cast("long")})
    docs = grouped(docs)
    # the first row of a group is a copy at the end of the group before it; one row of ids a group, which LEVELS bounds
    heads = docs.groupBy("_group").agg(F.max(F.struct("_id", "_tie")).alias("head"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("_group"))
    last = F.min("_group").over(Window.partitionBy(F.lit(0)))
    heads = F.broadcast(heads.select("head.*", F.coalesce(F.lag("_group").over(order), last).alias("_group")))
    copies = docs.drop("_group").join(heads, ["_id", "_tie"]).dropDuplicates(["_group"])
    both = docs.withColumn("_copy", F.lit(0)).unionByName(copies.withColumn("_copy", F.lit(1)))
    both = both.repartition("_group")  # texts alone are moved, the columns are computed where they are
    for name, sql in columns.items():
        both = both.withColumn(name, F.expr(sql))
    w = Window.partitionBy("_group").orderBy("_copy", F.desc("_id"), F.desc("_tie"))
    rows = both.withColumns({f"next_{c}": F.lead(c).over(w) for c in ("text", *columns)})
    return rows.where("_copy = 0").drop("_copy", "_id", "_tie", "_group")


def grouped(docs: DataFrame) -> DataFrame:
    """docs(_id, _tie, _group) with the number of a run of rows as _group, ascending with (_id, _tie); about GROUP rows each.

    Level by level, each group is cut at quantiles of its ids; one that has a single id, at quantiles of the ties.  A
    value that several quantiles share is set apart, so that the next level can cut it.
    """
    shares = F.array(*[F.lit(i / SPLITS) for i in range(1, SPLITS)])
    n = docs.count()
    for level in range(LEVELS):
        if n <= GROUP * SPLITS**level:
            break
        quantiles = lambda c: F.percentile_approx(c, shares, 2000)
        stats = docs.groupBy("_group").agg(F.count("*").alias("_n"), (F.min("_id") == F.max("_id")).alias("_same"), quantiles("_id").alias("_ids"), quantiles("_tie").alias("_ties"))
        cuts = F.when(F.col("_same"), F.col("_ties")).otherwise(F.col("_ids"))
        # every so many of the quantiles, for groups of about GROUP rows
        every = F.greatest(F.lit(1), F.floor(GROUP * SPLITS / F.col("_n"))).cast("int")
        stats = stats.select("_group", "_same", F.filter(cuts, lambda x, i: F.pmod(i + 1, every) == 0).alias("_cuts"))
        often = F.filter("_cuts", lambda x: (F.size(F.filter("_cuts", lambda y: x == y)) > 1) & (x < F.lit((1 << 63) - 1)))
        stats = stats.withColumn("_cuts", F.array_distinct(F.concat("_cuts", F.transform(often, lambda x: x + 1))))
        key = F.when(F.col("_same"), F.col("_tie")).otherwise(F.col("_id"))
        cell = F.col("_group") * (2 * SPLITS) + F.size(F.filter("_cuts", lambda x: x <= key))
        # at most (2 * SPLITS) ** (LEVELS - 1) rows of 1 kB
        docs = docs.join(F.broadcast(stats), "_group").withColumn("_group", cell.cast("long")).drop("_same", "_cuts")
    return docs


def edited(docs: DataFrame, **columns: str) -> DataFrame:
    """neighbours() with n_chars and the edited text: its last half replaced by the first of the next document's."""
    rows = neighbours(docs, **columns).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    return rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next_text", F.lit(1), half)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of docs(doc_id, text), and
    the recovered digests: removed and added by the edit, own_only and next_only of the document and the next."""
    rows = edited(docs, own=sketch(digests("text"))).withColumn("changed", F.expr(sketch(digests("edited"))))
    rows = rows.withColumns({"by_edit": F.expr(difference("own", "changed")), "to_next": F.expr(difference("own", "next_own"))})
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.expr(as_string("own")).alias("fingerprint"),
        F.expr(as_string("changed")).alias("edited_fingerprint"),
        F.expr(likeness("own", "changed", "by_edit")).alias("near_edited"),
        F.expr(likeness("own", "next_own", "to_next")).alias("near_next"),
        F.col("by_edit.one").alias("removed"),
        F.col("by_edit.two").alias("added"),
        F.col("to_next.one").alias("own_only"),
        F.col("to_next.two").alias("next_only"),
    )


def op10_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return fingerprints(table(spark, sf_dir, "documents"))
