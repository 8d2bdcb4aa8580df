"""Line dedup by a segment-partition edit join, in DataFrame operations only.

A line is cut into max_edits + 1 segments. Of two lines within max_edits edits, one segment of the one stands whole in the
other: segment i with at most i edits before it and max_edits - i after it. The first half of the segments is therefore
placed from the line's start, the second half from its end, and each is indexed at the few shifts that remain. Segment
sizes go by classes of length, so that lines of nearly the same length have the same ones. Lines that meet must also
share most of a finer row of pieces; what is left is compared by a banded bit-parallel edit distance, very long lines by
Landau and Vishkin's rows.

Many lines can share a segment and yet be far apart, as copies of a text with other words exchanged are. A bucket with more
than LARGE lines is split by where its lines leave its first line s. Let P_e(x) be the longest prefix of s that some prefix of x
has within e edits. If x and y are within k edits, P_0(x) <= P_k(y) and P_0(y) <= P_k(x): the spans from P_0 to P_k meet, and so
do those of the suffixes. Lines meet in cells of both spans only, each pair in one cell. Where a cell is still large, what all its lines
begin and end with is taken off, which leaves distances as they are, and the rest is cut into max_edits + 1 segments again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import cut, prepare, unique_ids


#: Buckets with more lines than this are split before all their lines meet.
LARGE = 16
#: Lines with more characters are compared by the rows of reach() alone, whose cost is that of a few readings of the line.
LONG = 1000
#: Parts of a bucket's first line, by which places of edits are told apart.
CELLS = 16


def length_class(l: str) -> str:  # noqa: E741
    """SQL for the least length of the class of lengths that l is in."""
    return f"(IF({l} < 64, {l} div 4 * 4, {l} div 16 * 16))"


def keys(k: int, c: str) -> str:
    """SQL for the array of keys of a line of length l for class c.

    Of two lines that meet in segment i, the places differ by m at most. Both are looked up at the shifts 0 to m, with m
    characters less than the segment has: one of the shifts of either line then shows the same part of it.
    """
    out = []
    for i in range(k + 1):
        left = i <= k // 2
        m, size = (i if left else k - i), f"({c} div {k + 1})"
        start = f"{i} * {size}" if left else f"l - {k + 1 - i} * {size}"
        out += [f"xxhash64({c}, {i}, substring(line, {start} + {1 + x}, {size} - {m}))" for x in range(m + 1)]
    return f"array({', '.join(out)})"


def reach(a: str, b: str, k: int) -> str:
    """SQL for an array of how far prefixes of b go along string a: the longest prefix of a that b has with no edit, the longest
    with k edits (Landau and Vishkin's rows), and whether the whole of b is within k edits of a (1 or 0).

    The columns la, lb are the lengths, and steps are powers of two, falling from the shorter length.
    """
    n, far = 2 * k, -100 - k
    same = lambda i, j: f"aggregate(steps, 0, (n, w) -> IF({i} + n + w <= la AND {j} + n + w <= lb AND substring({a}, {i} + n + 1, w) = substring({b}, {j} + n + 1, w), n + w, n))"
    begin = f"greatest(r[q] + 1, coalesce(get(r, q - 1), {far}), coalesce(get(r, q + 1), {far}) + 1)"
    row = f"transform(sequence(0, {n}), q -> transform(array(least({begin}, la, lb - q + {k})), i -> IF(i < 0, {far}, i + {same('i', f'(i + q - {k})')}))[0])"
    rows = f"aggregate(sequence(1, {k}), transform(sequence(0, {n}), q -> IF(q = {k}, r0, {far})), (r, e) -> {row})"
    return f"transform(array({same('0', '0')}), r0 -> transform(array({rows}), r -> array(r0, least(la, array_max(r)), IF(coalesce(get(r, lb - la + {k}), {far}) >= la, 1, 0)))[0])[0]"


def share_pieces(a: str, b: str, k: int) -> str:
    """SQL: are all but k of some pieces of a in b, shifted by k at most? True wherever the edit distance is at most k."""
    n = k + 5
    size = f"(length({a}) div {n})"
    found = [f"IF(locate(substring({a}, {j} * {size} + 1, {size}), substring({b}, greatest({j} * {size} + 1 - {k}, 1), {size} + {2 * k})) > 0, 1, 0)" for j in range(n)]
    return f"abs(length({a}) - length({b})) <= {k} AND {' + '.join(found)} >= {n - k}"


def share_all_pieces(a: str, b: str, k: int) -> str:
    """SQL: as share_pieces, for all pieces of three characters; dear, but far less so than a distance."""
    missing = f"filter(sequence(0, length({a}) div 3 - 1), j -> locate(substring({a}, 3 * j + 1, 3), substring({b}, greatest(3 * j + 1 - {k}, 1), {3 + 2 * k})) = 0)"
    return f"length({a}) < 3 OR size({missing}) <= {k}"


def within(a: str, b: str, k: int) -> str:
    """SQL: is the edit distance of strings a and b at most k?

    Bit-parallel over a diagonal band: bit x of a vector stands for pattern position j + x - k - 1 (from 1) while text
    position j is read, so a band of 2k + 2 bits is enough whatever the lengths are.
    """
    w = 2 * k + 2
    full = (1 << w) - 1
    equal = " | ".join(f"IF(element_at(p, j + {x}) = c, {1 << x}L, 0L)" for x in range(w))
    step = (
        f"(s, j) -> transform(array(element_at(t, j)), c -> transform(array({equal}), m -> transform(array(((((m & s.vp) + s.vp) ^ s.vp) | m | s.vn) & {full}L),"
        f" d -> transform(array((s.vn | ~(d | s.vp)) & {full}L), hp -> named_struct('vp', ((d & s.vp) | ~(shiftright(d, 1) | hp)) & {full}L, 'vn', shiftright(d, 1) & hp,"
        f" 'n', s.n + IF(j <= size(t) - s.cut, IF(d & {1 << (w - 1)}L = 0, 1, 0), IF(hp & s.bit <> 0, 1, 0) - IF(d & s.vp & s.bit <> 0, 1, 0)), 'bit', IF(j <= size(t) - s.cut, s.bit, shiftright(s.bit, 1)), 'cut', s.cut))[0])[0])[0])[0]"
    )
    # The longer string is the pattern, padded so that the band never leaves it; cut: text positions left when the band reaches its end.
    begin = f"named_struct('vp', {((1 << (k + 1)) - 1) << (w - k - 1)}L, 'vn', 0L, 'n', {k}, 'bit', {1 << (w - 2)}L, 'cut', {k} - (lp - size(t)))"
    pad = f"array_repeat('', {k + 1})"
    body = f"aggregate(sequence(1, size(t)), {begin}, {step}, s -> s.n) <= {k}"
    long, short = f"IF(length({a}) >= length({b}), {a}, {b})", f"IF(length({a}) >= length({b}), {b}, {a})"
    chars = lambda x: f"split({x}, '')"
    return f"IF(abs(length({a}) - length({b})) > {k}, false, IF(length({short}) = 0, true, transform(array(length({long})), lp -> transform(array(concat({pad}, {chars(long)}, {pad})), p -> transform(array({chars(short)}), t -> {body})[0])[0])[0]))"


def in_cells(buckets: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Entries of buckets with their lines, once for each cell of the bucket (key) that their spans touch.

    p0 to pk and q0 to qk are the spans of prefix and suffix, cell is the cell's place. An entry that is within k edits of the
    bucket's first line (open is false) is only there for others to meet.
    """
    heads = found.select(F.struct("id", "no").alias("star"), F.col("line").alias("head"))
    lines = buckets.select("key", "id", "no", "star").join(found, ["id", "no"]).join(heads, "star")
    lines = lines.select("key", "id", "no", "line", "head", F.reverse("line").alias("r_line"), F.reverse("head").alias("r_head"), F.length("head").alias("la"), F.length("line").alias("lb"))
    lines = lines.withColumn("steps", F.expr("transform(sequence(CAST(floor(log2(greatest(least(la, lb), 1))) AS INT), 0, -1), t -> shiftleft(1, t))"))
    lines = lines.select("key", "id", "no", "line", F.col("lb").alias("l"), F.expr(reach("head", "line", k)).alias("p"), F.expr(reach("r_head", "r_line", k)).alias("q"), F.expr(f"la div {CELLS} + 1").alias("w"))
    lines = lines.select("key", "id", "no", "line", "l", "w", *(F.col(c)[i].alias(f"{c}{n}") for c in "pq" for i, n in ((0, "0"), (1, "k"))), (F.col("p")[2] == 0).alias("open"))
    cells = F.expr("flatten(transform(sequence(p0 div w, pk div w), a -> transform(sequence(q0 div w, qk div w), b -> struct(a, b))))")
    out = lines.withColumn("cell", F.explode(cells))
    return out.withColumn("key", F.xxhash64("key", "cell")).withColumn("begin", F.expr("named_struct('a', p0 div w, 'b', q0 div w)")).drop("w")


def cut_again(cells: DataFrame, k: int) -> DataFrame:
    """Entries of cells once for each key of what is left of their lines without what all lines of the cell begin and end with."""
    one = Window.partitionBy("key")
    out = cells.withColumns({"p": F.min("p0").over(one), "q": F.min("q0").over(one), "least": F.min("l").over(one)})
    out = out.withColumns({"whole": F.col("line"), "all": F.col("l"), "line": F.expr("substring(line, p + 1, l - p - least(q, least - p))")}).withColumn("l", F.length("line"))
    out = out.withColumns({"c": F.expr(length_class("l")), "d": F.expr(length_class(f"greatest(l - {k}, 0)"))})
    out = out.withColumn("part", F.explode(F.expr(f"array_distinct(concat({keys(k, 'c')}, IF(c = d, array(), {keys(k, 'd')})))")))
    return out.withColumns({"key": F.xxhash64("key", "part"), "line": F.col("whole"), "l": F.col("all")}).select(cells.columns)


def near_in(buckets: DataFrame, k: int) -> DataFrame:
    """Those open entries (id, no) that are within k edits of an earlier entry of their bucket. A pair that meets in several cells is
    looked at where the later of their spans begin."""
    cols = ("id", "no", "l", "line", "p0", "pk", "q0", "qk", "begin")
    others = buckets.select("key", *(F.col(c).alias(f"o_{c}") for c in cols))
    first = "o_p0 <= pk AND p0 <= o_pk AND o_q0 <= qk AND q0 <= o_qk AND cell.a = greatest(begin.a, o_begin.a) AND cell.b = greatest(begin.b, o_begin.b)"
    pairs = buckets.where("open").join(others, "key").where(f"struct(o_id, o_no) < struct(id, no) AND abs(l - o_l) <= {k} AND {first}")
    return near_pairs(pairs, "line", "o_line", k).select("id", "no").distinct()


def near_pairs(pairs: DataFrame, a: str, b: str, k: int) -> DataFrame:
    """Pairs whose strings are within k edits; cheap tests come first."""
    short = " AND ".join(f"({test(a, b, k)})" for test in (share_all_pieces, within))
    steps = "transform(sequence(CAST(floor(log2(greatest(least(la, lb), 1))) AS INT), 0, -1), t -> shiftleft(1, t))"
    long = f"transform(array(length({a})), la -> transform(array(length({b})), lb -> transform(array({steps}), steps -> {reach(a, b, k)})[0])[0])[0][2] = 1"
    return pairs.where(f"({share_pieces(a, b, k)}) AND IF(length({a}) > {LONG}, {long}, {short})")


def has_word(line: Column | str) -> Column:
    return F.rlike(F.col(line) if isinstance(line, str) else line, F.lit(r"[^ \t\n\x0B\f\r]"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = 2, min_chars: int = 20, carry: tuple[str, ...] = (), exact_chars: int | None = None) -> DataFrame:
    """Takes out lines that stand, or nearly stand, earlier in the corpus.

    Lines are parts between \n with a word and min_chars characters at least, or exact_chars where that is given and less: lines of
    under min_chars are then looked at for equal ones only. Order is by id, then line. A line goes if an earlier line is equal
    (exact), or else if the first copy of another line within max_edits edits is earlier than its own first copy (near;
    whether or not that line goes too). Returns id, n_lines, n_exact, n_near and kept_text (the other lines, joined by \n) for
    each row of docs. A null text counts as empty. Rows with a null id keep all their lines. Of rows with the same id each has
    lines of its own, in the order of a hash of their texts; rows with the same id and text count as one and share its
    lines' fate. Equal lines are found by 128-bit hashes. Columns named in carry are returned as well; of rows with the same
    id and text, the least such columns stand for all. Ids may be of any type that can be ordered.
    """
    if min_chars <= max_edits:
        raise ValueError("min_chars must be over max_edits: each segment needs a character")
    least_chars = min_chars if exact_chars is None else min(exact_chars, min_chars)
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    unique = unique_ids(docs.where(F.col(id_col).isNotNull()), id_col)
    key = F.col(id_col) if unique else F.when(F.col(id_col).isNotNull(), F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("row")))
    base = docs.select(key.alias("id"), text.alias("text"))
    some = base.where("id is not null")
    dealt = some.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")
    counts = (F.length("line") >= least_chars) & has_word("line")
    lines = some.select("id", F.posexplode(F.split("text", "\n")).alias("no", "line")).where(counts)
    near_class = length_class(f"(l - {max_edits})")
    lines = lines.select("id", "no", "line", F.length("line").alias("l")).select("*", *(F.expr(f"IF(l < {min_chars}, NULL, {x})").alias(n) for n, x in (("c", length_class("l")), ("d", near_class))))
    lines = lines.select("id", "no", "l", F.xxhash64("line").alias("x"), F.xxhash64(F.lit(1), "line").alias("y"), F.expr(f"IF(l < {min_chars}, NULL, named_struct('c', c, 'keys', {keys(max_edits, 'c')}))").alias("own"), F.expr(f"IF(l < {min_chars} OR c = d, NULL, named_struct('c', d, 'keys', {keys(max_edits, 'd')}))").alias("below"))
    # Line numbers as a mask: whether a line is among them then takes one step, however many lines a text has.
    mask = lambda c: F.expr(f"flatten(transform({c}, (x, i) -> array_append(array_repeat(false, x - IF(i = 0, -1, {c}[greatest(i, 1) - 1]) - 1), true)))")
    among = lambda c, no: F.coalesce(F.get(F.col(c), no), F.lit(False))
    names = lines.groupBy("x", "y").agg(F.min(F.struct("id", "no", "l", "own", "below")).alias("first"))
    names = cut(names.select("first"))
    firsts = names.groupBy(F.col("first.id").alias("id")).agg(F.sort_array(F.collect_set("first.no")).alias("firsts")).select("id", mask("firsts").alias("firsts"))
    marked = dealt.join(firsts, "id", "left")
    at = F.struct("id", "no")
    def met(entries: DataFrame) -> DataFrame:
        """Entries of buckets (key) with several lines: each with the bucket's first line, and how many entries there are."""
        bucket = Window.partitionBy("key")
        out = entries.select("key", "id", "no", "l", F.min(at).over(bucket).alias("star"), F.max(at).over(bucket).alias("last"), F.count(F.lit(1)).over(bucket).alias("many"))
        return out.where("star <> last").drop("last")

    entries = names.select("first.id", "first.no", "first.l", F.explode(F.array("first.own", "first.below")).alias("k")).where("k is not null")
    coarse = cut(met(entries.select("id", "no", "l", F.explode("k.keys").alias("key"))))

    # From here on all but the cells is one query, in which the texts are dealt out once.
    among_ = coarse.groupBy("id").agg(F.sort_array(F.collect_set("no")).alias("needed")).select("id", mask("needed").alias("needed"))
    parts = dealt.join(among_, "id").select("id", "needed", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    found = parts.where(among("needed", F.col("no"))).groupBy("id", "no").agg(F.min("line").alias("line"))

    def near(pairs: DataFrame) -> DataFrame:
        """Those (id, no) of pairs (id, no, other) that are within max_edits of the other."""
        own = pairs.distinct().select("id", "no", F.col("other.id").alias("oid"), F.col("other.no").alias("ono")).join(found, ["id", "no"])
        both = own.join(found.select(F.col("id").alias("oid"), F.col("no").alias("ono"), F.col("line").alias("other")), ["oid", "ono"])
        return near_pairs(both, "line", "other", max_edits).select("id", "no").distinct()

    def with_first(buckets: DataFrame) -> DataFrame:
        return buckets.where(F.col("star") < at).select("id", "no", F.col("star").alias("other"))

    def with_all(buckets: DataFrame, settled: DataFrame) -> DataFrame:
        """Pairs of what is not settled with the others of its bucket."""
        others = buckets.select("key", at.alias("other"), F.col("star").alias("first"), F.col("l").alias("ol"))
        open_ = buckets.where("many > 2").drop("star").join(settled, ["id", "no"], "left_anti")
        return open_.join(others, "key").where((F.col("other") < at) & (F.col("other") != F.col("first")) & (F.abs(F.col("l") - F.col("ol")) <= max_edits)).select("id", "no", "other")

    settled = near(with_first(coarse))
    settled = settled.union(near(with_all(coarse.where(F.col("many") <= LARGE), settled)))
    large = coarse.where(F.col("many") > LARGE)
    if not large.isEmpty():
        cells = cut(in_cells(large, found, max_edits).withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("key"))))
        settled = settled.union(near_in(cells.where(F.col("many") <= LARGE), max_edits))
        settled = settled.union(near_in(cut_again(cells.where(F.col("many") > LARGE), max_edits), max_edits))
    lost = settled.groupBy("id").agg(F.sort_array(F.collect_set("no")).alias("nears")).select("id", mask("nears").alias("nears"))
    # A later copy of a line that has gone counts as exact.
    empty = F.array().cast("array<boolean>")
    out = marked.join(lost, "id", "left")
    if carry:
        out = out.join(docs.select(key.alias("id"), F.struct(*carry).alias("more")).where("id is not null").groupBy("id").agg(F.min("more").alias("more")), "id", "left")
    none = F.lit(None).cast("array<boolean>")
    rest = docs.where(F.col(id_col).isNull()).select(key.alias("id"), text.alias("text"), none.alias("firsts"), none.alias("nears"), *([F.struct(*carry).alias("more")] if carry else []))
    out = out.select(rest.columns).union(rest)
    out = out.withColumns({"firsts": F.coalesce("firsts", empty), "nears": F.coalesce("nears", empty)})
    fits = lambda x: (F.length(x) >= least_chars) & has_word(x) & F.col("id").isNotNull()
    state = lambda x, i: F.when(~fits(x), 0).when(~among("firsts", i), 2).when(among("nears", i), 3).otherwise(1)
    # Each line beside its state: no line's state is then looked up in an array that the optimizer may build anew for each line.
    out = out.withColumn("lines", F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("line"), state(x, i).alias("state")))).drop("text")
    tally = lambda name, *s: F.size(F.filter("lines", lambda x: x.state.isin(*s))).cast("long").alias(name)
    kept = F.array_join(F.transform(F.filter("lines", lambda x: x.state < 2), lambda x: x.line), "\n").alias("kept_text")
    # From a generator, since filters on these columns are not pushed below one: there, each would work its columns out again.
    once = F.inline(F.array(F.struct(tally("n_lines", 1, 2, 3), tally("n_exact", 2), tally("n_near", 3), kept)))
    return out.select((F.col("id") if unique else F.col("id")["id"]).alias(id_col), once, *(F.col("more")[c].alias(c) for c in carry))
