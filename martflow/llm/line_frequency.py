"""Operator 9, quality rules: repetition within a text, line frequency across texts.

Base rules look at one text: too few words, or too many words in repeated five-word
windows. The method looks across texts: lines are normalised (ASCII letters in lower
case, white space runs one space, none at the ends) and hashed; a line is boilerplate
of its host when more than ``least_docs`` of the host's distinct documents hold it and
they are more than ``share`` of them. Boilerplate is taken out, and a document is
rejected as depleted when fewer than ``least_words`` words or less than ``left`` of
its words remain. The limits are shares, so they behave alike at every size. ``judge``
counts the words taken out of each document; ``keep_good`` gives the texts without them.

Copies of one text on a host count as one document, so that copying alone makes no
line boilerplate. Each document gives a line at most once, counts are combined before
they are shuffled, and the boilerplate of a host is at most ``1 / share`` times the
lines of an average document.

Defined results: a null text has no words and is rejected; a null host is a host of
its own; repeated rows get the same verdict each; an empty table gives no rows;
a null ``doc_id`` stays null; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import returning, small_side, table
from martflow.plans.staging import stage

LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of a text's words
WINDOW = 5
LEAST_DOCS = 20
SHARE = 0.1
LEFT = 0.3
_ROWS = 400  # texts measured at once; it bounds a worker's memory
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MEASURES_DDL = ", ".join(f"{m} long" for m in MEASURES)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; different numbers stay different."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_words(codes: np.ndarray, docs: np.ndarray, count: int) -> np.ndarray:
    """Per document, its words in windows it holds twice or more.

    ``codes`` names the words, ``docs`` their documents, ascending from 0 below ``count``.
    """
    covered = np.zeros(count, np.int64)
    windows = len(codes) - WINDOW + 1
    if windows < 2:
        return covered
    with np.errstate(over="ignore"):
        word = _mix(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        key = _mix(docs[:windows].astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
        for k in range(WINDOW):
            key = (key + word[k : k + windows]) * np.uint64(0xD6E8FEB86659FD93)
            key ^= key >> np.uint64(32)
    inside = np.flatnonzero(docs[:windows] == docs[WINDOW - 1 :])
    order = inside[np.argsort(key[inside])]
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(windows, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(codes) + 1, np.int32)
    change[:windows] += twice
    change[WINDOW : WINDOW + windows] -= twice
    held = np.cumsum(change[:-1]) > 0
    return np.bincount(docs[held], minlength=count).astype(np.int64)


def measure(texts) -> tuple[dict[str, np.ndarray], dict]:
    """Measures of an Arrow array of texts, and each text's distinct lines.

    The lines come as offsets into arrays of hashes and of words they hold in the text;
    ``every`` has the hashes of all lines in their order, blank ones too, from ``starts`` on.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    import xxhash

    rows = len(texts)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: rows + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    raw = raw[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]

    def per_text(marked: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(marked), bounds))

    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    docs = np.repeat(np.arange(rows), np.diff(split.offsets.to_numpy()))
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:  # what stands before the first or after the last word
        docs, codes = docs[codes != blank], codes[codes != blank]

    lines = pc.split_pattern(texts, "\n")
    line_doc = np.repeat(np.arange(rows), np.diff(lines.offsets.to_numpy()))
    line = lines.flatten().dictionary_encode()
    shown = pc.ascii_trim_whitespace(line.dictionary)
    real = pc.not_equal(shown, "").to_numpy(zero_copy_only=False)
    every = line_code = line.indices.to_numpy(zero_copy_only=False)
    line_doc, line_code = line_doc[real[line_code]], line_code[real[line_code]]
    kinds = max(1, len(real))
    own, times = np.unique(line_doc * kinds + line_code, return_counts=True)
    own_doc, own_code = own // kinds, own % kinds

    plain = pc.replace_substring_regex(pc.ascii_lower(shown), r"[\x20\x09-\x0D]+", " ")
    words = (pc.count_substring(plain, " ").to_numpy(zero_copy_only=False) + 1).astype(np.int64)
    hashes = np.fromiter(
        (xxhash.xxh3_64_intdigest(x) for x in plain.cast(pa.large_binary()).to_pylist()),
        np.uint64,
        len(plain),
    ).view(np.int64)
    # lines that differ only before normalising are one
    order = np.lexsort((hashes[own_code], own_doc))
    doc, key = own_doc[order], hashes[own_code][order]
    held = (times * words[own_code])[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    starts = np.flatnonzero(first)
    return {
        "n_words": np.bincount(docs, minlength=rows),
        "word_chars": chars - per_text(_SPACE[raw]),
        "n_symbols": per_text(_SYMBOL[raw]),
        "n_dup_lines": np.bincount(line_doc, minlength=rows) - np.bincount(own_doc, minlength=rows),
        "n_repeat_words": repeated_words(codes, docs, rows),
    }, {
        "offsets": np.searchsorted(doc[starts], np.arange(rows + 1)),
        "line": key[starts],
        "words": np.add.reduceat(held, starts) if len(starts) else held,
        "starts": lines.offsets.to_numpy() - lines.offsets[0].as_py(),
        "every": hashes[every],
    }


def _measured(text_column: str, with_lines: bool):
    """For ``mapInArrow``: put measures and lines behind the columns.

    With lines they are the distinct ones, in place of the text; else all, in their order.
    """

    def add(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        import xxhash

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                texts = part.column(text_column)
                found, lines = measure(texts)
                columns = [pa.array(found[m], pa.int64()) for m in MEASURES]
                raw = texts.cast(pa.binary()).to_pylist()
                columns.append(
                    pa.array([None if x is None else xxhash.xxh3_128_digest(x) for x in raw], pa.binary())
                )
                names = [*MEASURES, "text_key"]
                if with_lines:
                    offsets = pa.array(lines["offsets"], pa.int32())
                    columns += [
                        pa.ListArray.from_arrays(offsets, pa.array(lines["line"], pa.int64())),
                        pa.ListArray.from_arrays(offsets, pa.array(lines["words"], pa.int64())),
                    ]
                    names += ["line", "line_words"]
                    keep = [n for n in part.schema.names if n != text_column]
                else:
                    starts = pa.array(lines["starts"], pa.int32())
                    columns.append(pa.ListArray.from_arrays(starts, pa.array(lines["every"], pa.int64())))
                    names.append("every_line")
                    keep = part.schema.names
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in keep] + columns, names=[*keep, *names]
                )

    return returning(add)


def base_failed(n_words="n_words", n_repeat_words="n_repeat_words"):
    few = F.col(n_words) < LEAST_WORDS
    return few | (100 * F.col(n_repeat_words) > MOST_REPEATED * F.col(n_words))


def measured(documents: DataFrame, host: str = "source") -> DataFrame:
    """Rows (row, doc_id, host, measures, text_key, line, line_words), written once."""
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), "text"
    )
    found = docs.mapInArrow(
        _measured("text", True),
        f"doc_id long, host string, {_MEASURES_DDL}, text_key binary, "
        "line array<long>, line_words array<long>",
    )
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "line-measures")


def boilerplate(
    rows: DataFrame, least_docs: int = LEAST_DOCS, share: float = SHARE
) -> DataFrame:
    """(host, line) held by more than both limits of the host's distinct documents."""
    distinct = rows.groupBy("host", "text_key").agg(F.first("line").alias("line"))
    distinct = stage(distinct.drop("text_key"), "line-documents")
    sizes = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    held = distinct.select("host", F.explode("line").alias("line"))
    held = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"))
    held = held.filter(F.col("docs") > least_docs)
    sizes = sizes.withColumnRenamed("host", "of_host")
    often = held.join(sizes, F.col("host").eqNullSafe(F.col("of_host")))
    return often.filter(F.col("docs") > share * F.col("host_docs")).select("host", "line", "docs")


def depleted_rows(
    rows: DataFrame,
    often: DataFrame,
    least_words: int = LEAST_WORDS,
    left: float = LEFT,
) -> DataFrame:
    """Of rows that hold boilerplate: row, words it takes, its lines, whether too little remains."""
    pairs = F.explode(F.arrays_zip("line", "line_words")).alias("own")
    held = rows.select("row", "host", "n_words", pairs)
    held = held.select("row", "host", "n_words", "own.line", "own.line_words")
    often = often.select(F.col("host").alias("of_host"), F.col("line").alias("of_line"))
    held = held.join(
        often, (F.col("line") == F.col("of_line")) & F.col("host").eqNullSafe(F.col("of_host"))
    )
    taken = held.groupBy("row").agg(
        F.sum("line_words").alias("n_removed_words"), F.first("n_words").alias("n_all"),
        F.collect_list("line").alias("often_lines"),
    )
    rest = F.col("n_all") - F.col("n_removed_words")
    few = (rest < least_words) | (rest < left * F.col("n_all"))
    return taken.select("row", "n_removed_words", "often_lines", few.alias("depleted"))


def judge(documents: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, the measures, base_failed, n_removed_words, kept; a row for each row."""
    rows = measured(documents, host)
    often = stage(boilerplate(rows), "boilerplate")
    taken = depleted_rows(rows, often)
    found = rows.drop("line", "line_words").join(taken, "row", "left")
    removed = F.coalesce("n_removed_words", F.lit(0)).alias("n_removed_words")
    gone = F.coalesce("depleted", F.lit(False))
    found = found.withColumn("base_failed", base_failed())
    kept = (~F.col("base_failed") & ~gone).alias("kept")
    return found.select("doc_id", *MEASURES, "base_failed", removed, kept)


def keep_good(documents: DataFrame, host: str = "source") -> DataFrame:
    """The rows that pass, their texts without boilerplate lines, other columns as they are.

    Base rules are applied as the texts pass by; only the keys of texts with boilerplate
    and its lines, written to a table whose size Spark then knows, are joined with them.
    """
    rows = measured(documents, host)
    often = stage(boilerplate(rows), "boilerplate")
    taken = depleted_rows(rows, often).select("row", "often_lines", "depleted")
    held = rows.select("row", "host", "text_key", "n_words", "n_repeat_words")
    held = held.filter(~base_failed()).join(taken, "row")
    held = held.groupBy(F.col("host").alias("of_host"), F.col("text_key").alias("of_key"))
    held = held.agg(F.first("often_lines").alias("often_lines"), F.first("depleted").alias("depleted"))
    held = small_side(stage(held, "boilerplate-texts"))

    names = {c: f"c{i}" for i, c in enumerate(documents.columns)}
    inner = documents.select([F.col(f"`{c}`").alias(n) for c, n in names.items()])
    text, kind = names["text"], inner.schema[names["text"]].dataType
    if kind.simpleString() != "string":
        text = "text"
        inner = inner.withColumn(text, F.col(names["text"]).cast("string"))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields)
    passed = inner.mapInArrow(
        _measured(text, False), f"{ddl}, {_MEASURES_DDL}, text_key binary, every_line array<long>"
    )
    passed = passed.filter(~base_failed())
    own = F.col(names[host]).cast("string")
    passed = passed.join(
        held, (F.col("text_key") == F.col("of_key")) & own.eqNullSafe(F.col("of_host")), "left"
    )
    passed = passed.filter(~F.coalesce("depleted", F.lit(False)))
    lines = F.arrays_zip(F.split(text, "\n", -1).alias("shown"), F.col("every_line").alias("line"))
    lines = F.filter(lines, lambda x: ~F.array_contains(F.col("often_lines"), x["line"]))
    rest = F.array_join(F.transform(lines, lambda x: x["shown"]), "\n").cast(kind)
    clean = F.when(F.col("often_lines").isNull(), F.col(names["text"])).otherwise(rest)
    return passed.select(
        [(clean if c == "text" else F.col(n)).alias(c) for c, n in names.items()]
    )


def op9_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all documents; the host is their source."""
    return judge(table(spark, sf_dir, "documents"))


#: The same in SQL; it compares the normalised lines themselves.
OP9_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text, text AS raw
  FROM documents
), words AS (
  SELECT row, word, idx FROM (
    SELECT row, unnest(ws) AS word, generate_subscripts(ws, 1) AS idx
    FROM (SELECT row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM docs))
), counted AS (
  SELECT row, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY row
), grams AS (
  SELECT row, idx, word || chr(10) || lead(word, 1) OVER w || chr(10) || lead(word, 2) OVER w
    || chr(10) || lead(word, 3) OVER w || chr(10) || lead(word, 4) OVER w AS gram
  FROM words WINDOW w AS (PARTITION BY row ORDER BY idx)
), twice AS (
  SELECT row, idx FROM (SELECT row, idx, count(*) OVER (PARTITION BY row, gram) AS n
    FROM grams WHERE gram IS NOT NULL) WHERE n > 1
), covered AS (
  SELECT row, count(DISTINCT idx + k) AS n_repeat_words
  FROM twice, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY row
), lines AS (
  SELECT row, source, raw, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain
  FROM (SELECT row, source, raw, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dups AS (
  SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY row
), hosts AS (
  SELECT source, count(DISTINCT raw) + max((raw IS NULL)::INT) AS n FROM docs GROUP BY source
), often AS (
  SELECT l.source, l.plain FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, l.plain, h.n
  HAVING count(DISTINCT raw) > 20 AND count(DISTINCT raw) > 0.1 * h.n
), taken AS (
  SELECT row, sum(l.n) AS n_removed_words
  FROM lines l JOIN often o ON l.plain = o.plain AND l.source IS NOT DISTINCT FROM o.source
  GROUP BY row
), found AS (
  SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_removed_words, 0)::BIGINT AS n_removed_words
  FROM docs LEFT JOIN counted USING (row) LEFT JOIN covered USING (row)
    LEFT JOIN dups USING (row) LEFT JOIN taken USING (row)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM found
)
SELECT *, NOT base_failed AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < 10
  OR n_words - n_removed_words < 0.3 * n_words)) AS kept
FROM judged
"""
