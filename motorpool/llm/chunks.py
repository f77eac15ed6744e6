"""Line de-duplication by content-defined chunks of lines.

A rolling hash over the hashes of two neighbouring lines chooses where chunks lie: after a line whose rolling hash is
the smaller of its own and a neighbour's, and wherever one of the two lines is long. The choice depends on the lines
around it alone, so text put in before a passage does not shift the chunks within it, and every three lines hold one.
A chunk is the two lines that its rolling hash covers, or a single very long line. Chunks that occurred before, found
by hash and compared byte by byte, mark their lines; runs of marked lines with enough words are taken out whole, so a
copied passage goes from its first line to its last. Everything is built-in column code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import written

#: Beside a line of so many characters there is always a chunk.
LINE_CHARS = 40
#: Words of a run that goes, and of a line that is a chunk by itself.
LONG_WORDS = 50
#: Ids of documents with repeated chunks are broadcast to the scan of the texts up to this number (8 bytes each); above
#: it the texts are shuffled by id.
BROADCAST_IDS = 1_000_000
_WORD = r"'[^ \\t\\r\\n]+'"


def chunk_places(docs: DataFrame, text: str, line_chars: int = LINE_CHARS, long_words: int = LONG_WORDS) -> DataFrame:
    """``docs`` with ``_chunks``: first line, last line (from 0) and hash of each chunk of the text."""
    marked = docs.withColumn("_lines", F.split(F.col(text), "\n", -1)).withColumn("_marks", F.expr(f"""transform(_lines, l -> struct(
        cast(conv(substring(md5(l), 1, 8), 16, 10) as bigint) as h, length(l) >= {line_chars} as long, l rlike {_WORD} as solid,
        length(l) >= {2 * long_words - 1} and regexp_count(l, {_WORD}) >= {long_words} as alone))"""))
    marked = marked.withColumn("_roll", F.expr("transform(sequence(0, size(_lines) - 1), i -> get(_marks, i - 1).h * 31 + get(_marks, i).h)"))
    pairs = """transform(filter(sequence(0, size(_lines) - 1), i -> i > 0 and (get(_marks, i).solid or get(_marks, i - 1).solid)
        and (get(_marks, i).long or get(_marks, i - 1).long or i = 1 or i = size(_lines) - 1 or get(_roll, i) < get(_roll, i - 1) or get(_roll, i) <= get(_roll, i + 1))),
        i -> struct(i - 1 as f, i as i, xxhash64(get(_lines, i - 1), get(_lines, i)) as h))"""
    single = "transform(filter(sequence(0, size(_lines) - 1), i -> get(_marks, i).alone), i -> struct(i as f, i as i, xxhash64(get(_lines, i)) as h))"
    return marked.withColumn("_chunks", F.expr(f"concat({pairs}, {single})")).drop("_lines", "_marks", "_roll")


def _repeated(base: DataFrame, line_chars: int, long_words: int) -> DataFrame:
    """(_id, _lines): the lines of each document that stand in a chunk which occurred before, ascending."""
    # a plain inline would have a filter on its input's size pushed below the steps, which then run once per line
    places = chunk_places(base, "_text", line_chars, long_words).select("_id", F.inline_outer("_chunks").alias("f", "i", "h"))
    places = written(places.where("h is not null"), "places")
    first = places.groupBy("h").agg(F.min(F.struct("_id", "i")).alias("a"), F.count("*").alias("n")).where("n > 1")
    again = places.join(first, "h").select("_id", F.struct("i", "f", "h", F.expr("_id = a._id and i = a.i").alias("lead")).alias("c"))
    listed = written(again.groupBy("_id").agg(F.collect_set("c").alias("list")), "listed")
    ids = listed.select("_id")
    near = base.join(F.broadcast(ids), "_id", "left_semi") if ids.count() <= BROADCAST_IDS else base
    texts = near.join(listed, "_id").withColumn("_split", F.split("_text", "\n", -1))
    part = "transform(list, c -> struct(c.i, c.f, c.h, c.lead, array_join(slice(_split, c.f + 1, c.i - c.f + 1), '\\n') as part))"
    texts = written(texts.select("_id", F.inline_outer(F.expr(part))), "passages")
    keeper = texts.where("lead").select("h", F.col("part").alias("same")).dropDuplicates(["h"])
    compared = texts.where("not lead").join(keeper, "h")
    seen = compared.where("part = same").select("_id", "f", "i")
    # equal hash, other bytes: the same rule among the texts of that hash, so that a collision costs no removal
    other = compared.where("part <> same")
    own = other.groupBy("h", "part").agg(F.min(F.struct("_id", "i")).alias("a"))
    seen = seen.union(other.join(own, ["h", "part"]).where("not (_id = a._id and i = a.i)").select("_id", "f", "i"))
    lines = F.array_union(F.collect_set("f"), F.collect_set("i"))
    return seen.groupBy("_id").agg(F.sort_array(lines).alias("_lines"))


def drop_repeated(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", line_chars: int = LINE_CHARS, long_words: int = LONG_WORDS
) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``, and the counts ``n_lines`` and ``n_removed`` of lines.

    Taken out is every maximal run of lines that all stand in chunks which occurred before, by (id, place in the
    document), if it has ``long_words`` words; each line stays at its first place. Null texts stay null with no lines,
    empty ones stay empty. Rows that repeat an id are the same document: equal ones get equal results. Rows without an
    id keep their text and count for nothing. All other columns are passed through, whatever their names.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).where("_id is not null and _text is not null")
    gone = _repeated(base, line_chars, long_words)
    ident, marks = _unused(docs, "ident"), _unused(docs, "marks")
    gone = gone.select(F.col("_id").alias(ident), F.col("_lines").alias(marks))
    # the row as one column: names of the caller's columns cannot meet those of the steps
    rows = docs.join(gone, F.col(id_col) == F.col(ident), "left").select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(marks).alias("m"))
    rows = rows.withColumn("lines", F.split(F.col("row").getField(text), "\n", -1))
    first, last = "filter(m, (x, k) -> k = 0 or get(m, k - 1) <> x - 1)", "filter(m, (x, k) -> k = size(m) - 1 or get(m, k + 1) <> x + 1)"
    words = f"regexp_count(array_join(slice(lines, r.s + 1, r.e - r.s + 1), '\\n'), {_WORD})"
    rows = rows.withColumn("runs", F.expr(f"filter(zip_with({first}, {last}, (s, e) -> struct(s, e)), r -> {words} >= {long_words})")).withColumn("pin", F.spark_partition_id())
    # what stands before the first run, between the runs and after the last one
    rest = "flatten(transform(sequence(0, size(runs)), j -> slice(lines, coalesce(get(runs, j - 1).e, -1) + 2, coalesce(get(runs, j).s, size(lines)) - coalesce(get(runs, j - 1).e, -1) - 1)))"
    # the caller's filters on the results stay above a step with a partition id, and so do not repeat what is below
    out = rows.withColumn("kept", F.expr(f"case when pin >= 0 and lines is not null and size(runs) > 0 then array_join({rest}, '\\n') else row.`{text}` end"))
    removed = F.expr("case when pin >= 0 then aggregate(runs, 0L, (n, r) -> n + r.e - r.s + 1) end")
    return out.select(
        *[F.col("kept").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns],
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"), F.coalesce(removed, F.lit(0)).alias("n_removed"),
    )


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name = "_" + name
    return name


#: The same result in DuckDB, by the texts themselves in place of hashes.
ORACLE = rf"""
with l as (select doc_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) - 1 i, len(string_split(text, chr(10))) n from documents where text is not null),
h as (select *, ('0x' || substr(md5(line), 1, 8))::bigint h, len(regexp_extract_all(line, '[^ \t\r\n]+')) w, lag(line) over d before from l window d as (partition by doc_id order by i)),
r as (select *, lag(h) over d * 31 + h r, lag(length(line)) over d lb, lag(w) over d wb from h window d as (partition by doc_id order by i)),
b as (select *, lag(r) over d rb, lead(r) over d ra from r window d as (partition by doc_id order by i)),
c as (select doc_id, i - 1 f, i, before || chr(10) || line part from b where i > 0 and w + wb > 0
    and (length(line) >= {LINE_CHARS} or lb >= {LINE_CHARS} or i = 1 or i = n - 1 or coalesce(r < rb, false) or coalesce(r <= ra, false))
  union all select doc_id, i, i, line from b where w >= {LONG_WORDS}),
s as (select *, row_number() over (partition by part order by doc_id, i) > 1 seen from c),
m as (select doc_id, f i from s where seen union select doc_id, i from s where seen),
g as (select doc_id, i, i - row_number() over (partition by doc_id order by i) run from m),
x as (select g.doc_id, g.run from g join h on h.doc_id = g.doc_id and h.i = g.i group by all having sum(w) >= {LONG_WORDS}),
o as (select g.doc_id, g.i from g join x on x.doc_id = g.doc_id and x.run = g.run),
t as (select l.doc_id, string_agg(line, chr(10) order by l.i) filter (where o.i is null) as text, count(*) n_lines, count(o.i) n_removed from l left join o on o.doc_id = l.doc_id and o.i = l.i group by l.doc_id)
select d.doc_id, case when d.text is null then null else coalesce(t.text, '') end as text, coalesce(n_lines, 0) n_lines, coalesce(n_removed, 0) n_removed
from documents d left join t using (doc_id)
"""
