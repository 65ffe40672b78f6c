"""Line dedup by content-defined chunks.

A rolling hash over the hashes of two neighbouring lines is taken at every line; a chunk
begins where it is lower than at both neighbours. Equal lines in a row have one rolling hash: a run of
them is set apart from its neighbours and cut into pairs. A boundary depends on four lines only
(and on the parity of the place inside a run, where all pairs are alike), so chunks of a passage
come out alike wherever it is inserted. Chunks of several lines that occur more than once anywhere keep
their first occurrence (smallest doc_id, then place); others go, after their bytes have been
compared with the first one's. A chunk that goes takes along the lines before and after it, as far
as they equal the lines around the first occurrence, up to two chunks on either side: foreign
lines beside a passage can shift one boundary at each of its ends, so a passage that holds a whole
chunk goes from its first line to its last. Every line that goes has an equal line at an earlier
place, so one of each stays.
"""

from pyspark.sql import functions as F

from txlens.llm.textkit import once
from txlens.staging import stage

#: The rolling hash works modulo this prime, with this factor for the earlier line.
PRIME = 2147483647
FACTOR = 1103515245


def _starts(lines):
    """First lines of the chunks. Every step is bound once, so no optimiser can nest its work."""
    def hashed(x):
        return F.conv(F.substring(F.md5(x), 1, 15), 16, 10).cast("long") % PRIME

    def rolled(h):
        return F.struct(h.alias("h"), F.transform(
            h, lambda x, i: (F.coalesce(F.get(h, i - 1), F.lit(0).cast("long")) * FACTOR + x) % PRIME).alias("r"))

    def opened(bound):
        h, r = bound["h"], bound["r"]
        after = F.lit(PRIME).cast("long")

        def opens(x, i):
            like_last, like_next = x.eqNullSafe(F.get(h, i - 1)), x.eqNullSafe(F.get(h, i + 1))
            lowest = (F.get(r, i) < F.get(r, i - 1)) & (F.get(r, i) < F.coalesce(F.get(r, i + 1), after))
            run_before = (i > 1) & F.get(h, i - 1).eqNullSafe(F.get(h, i - 2))
            return F.when((i == 0) | F.when(like_last, like_next & (i % 2 == 0))
                          .otherwise(lowest | like_next | run_before), i)

        return F.filter(F.transform(h, opens), lambda i: i.isNotNull())

    return once(once(F.transform(lines, hashed), rolled), opened)


def _lines():
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)


def _places(lines):
    """The chunks: first line and line after the last, of the chunk and of it with two chunks on either side."""
    def spans(bound):
        starts, n = bound["starts"], bound["n"]

        def place(s, k):
            end = F.coalesce(F.get(starts, k + 1), n)
            return F.struct(s.cast("int").alias("start"), end.cast("int").alias("end"),
                            F.coalesce(F.get(starts, k - 2), F.lit(0)).cast("int").alias("low"),
                            F.coalesce(F.get(starts, k + 3), n).cast("int").alias("high"))

        return F.transform(starts, place)

    return once(F.struct(_starts(lines).alias("starts"), F.size(lines).alias("n")), spans)


def _cut(start, end):
    return F.slice("_lines", start + 1, end - start)


def _agreeing(lines, others):
    """How many lines from the first on are equal."""
    return F.coalesce(F.array_min(F.transform(lines, lambda x, i: F.when(~x.eqNullSafe(F.get(others, i)), i))),
                      F.size(lines))


def _rows(docs):
    """``doc_id, text, _mark`` (a hash of the text): rows that agree in them are one document."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("_mark"))


def repeated_spans(docs):
    """``doc_id, _mark, gone``: the lines to remove from each document that has any.

    ``gone`` is a sorted array of first line and line after the last. Only hashes travel until a chunk
    is known to be repeated.
    """
    rows = _rows(docs)
    seen = (rows.withColumn("_lines", _lines())
            .select("doc_id", "_mark", "_lines", F.explode(F.filter(
                _places(F.col("_lines")), lambda c: c["end"] - c["start"] > 1)).alias("c"))
            .withColumn("_text", F.array_join(_cut(F.col("c.start"), F.col("c.end")), "\n"))
            .where(F.col("_text").rlike("[^\\x20\\x09-\\x0D]"))
            .select("doc_id", "_mark", "c.*", F.unhex(F.md5("_text")).alias("digest")))
    seen = stage(seen.where("doc_id is not null"))
    # written, as is what is held, so that the join with a chunk of all documents can be split
    firsts = stage(seen.groupBy("digest").agg(F.min(F.struct("doc_id", "_mark", "start")).alias("first"),
                                              F.count("*").alias("n"))
                   .where("n > 1").select("digest", "first"))
    one = F.struct("start", "end", "low", "high", "digest",
                   (F.struct("doc_id", "_mark", "start") == F.col("first")).alias("is_first"))
    wanted = (seen.join(firsts, "digest").select("doc_id", "_mark", one.alias("one"))
              .groupBy("doc_id", "_mark").agg(F.collect_set("one").alias("wanted")))
    bodies = stage(rows.join(wanted, ["doc_id", "_mark"]).withColumn("_lines", _lines())
                   .select("doc_id", "_mark", "_lines", F.explode("wanted").alias("one"))
                   .select("doc_id", "_mark", "_lines", "one.*")
                   .select("doc_id", "_mark", "start", "end", "digest", "is_first",
                           F.array_join(_cut(F.col("start"), F.col("end")), "\n").alias("bytes"),
                           F.reverse(_cut(F.col("low"), F.col("start"))).alias("before"),
                           _cut(F.col("end"), F.col("high")).alias("after")))
    held = stage(bodies.where("is_first").select(
        "digest", F.col("bytes").alias("first_bytes"), F.col("before").alias("first_before"),
        F.col("after").alias("first_after")).distinct())
    span = F.struct((F.col("start") - _agreeing("before", F.col("first_before"))).alias("start"),
                    (F.col("end") + _agreeing("after", F.col("first_after"))).alias("end"))
    return (bodies.where("not is_first").join(held, "digest").where("bytes = first_bytes")
            .select("doc_id", "_mark", span.alias("span"))
            .groupBy("doc_id", "_mark").agg(F.array_sort(F.collect_set("span")).alias("gone")))


def dedup_lines(docs):
    """``docs`` with repeated passages taken out of ``text``; other columns and rows stay.

    Adds ``n_lines`` and ``n_removed_lines`` (long), in place of columns with these names. A null
    text stays null (no lines). A text that loses nothing is returned byte for byte. Rows that
    share doc_id and text are one document and change alike; rows that share the doc_id only are
    documents of their own, ordered by a hash of the text. Rows with a null doc_id stay as they are. A
    chunk without a word stays, unless it stands beside one that goes.
    """
    gone = repeated_spans(docs).select(F.col("doc_id").alias("_id"), F.col("_mark").alias("_gone_mark"), "gone")
    text = F.col("text").cast("string")
    # the text travels once, inside its row
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("_mark"),
                         F.struct("*").alias("_row"))
    cut = (packed.join(gone, (F.col("doc_id") == F.col("_id")) & (F.col("_mark") == F.col("_gone_mark")), "left")
           .withColumn("text", F.col("_row.text").cast("string")).withColumn("_lines", _lines()))

    def left_over(bound):
        lines, spans = bound["lines"], bound["gone"]
        pieces = F.transform(F.array_append(spans, F.struct(F.size(lines).alias("start"), F.size(lines).alias("end"))),
                             lambda s, k: F.struct(F.coalesce(F.get(spans, k - 1)["end"], F.lit(0)).alias("start"),
                                                   s["start"].alias("end")))
        return F.flatten(F.transform(pieces, lambda p: F.slice(
            lines, p["start"] + 1, F.greatest(p["end"] - p["start"], F.lit(0)))))

    kept = F.when(F.col("gone").isNotNull(), once(F.struct(F.col("_lines").alias("lines"), "gone"), left_over))
    cut = cut.select("text", "_row", F.size("_lines").alias("_n"), kept.alias("_kept"))
    row = F.col("_row").withField("text", F.when(F.col("_kept").isNull(), F.col("text"))
                                  .otherwise(F.array_join("_kept", "\n")))
    others = [row[name].alias(name) for name in docs.columns if name not in ("n_lines", "n_removed_lines")]
    removed = F.when(F.col("_kept").isNotNull(), F.col("_n") - F.size("_kept")).otherwise(0)
    return cut.select(
        *others, F.when(F.col("text").isNotNull(), F.col("_n")).otherwise(0).cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed_lines"))
