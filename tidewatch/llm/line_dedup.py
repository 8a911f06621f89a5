"""Line dedup by winnowing, with native columns only.

A line ends at a line break, after a punctuation mark and a space, or after a
mark of a script that puts no space there. A passage is a run of whole lines of
at least MIN_WORDS words. Winnowing selects a fingerprint in every passage: from
each line on, the smallest hash of the pairs of neighbouring lines that lie in
the shortest passage there, WINDOW pairs at most, or the line itself if it is
one. Around the fingerprints that stand twice, every shortest passage (none of
its ends can be left out) is hashed as a whole and joined to the first document
that holds it, whatever else its lines or pairs occur in. A line is deleted if
a shortest passage around it stands in an earlier document, or earlier in its
own; as longer passages are made of shortest ones, no repeat is lost.

Only numbers move: line hashes as one array per document, fingerprints, and the
passages around shared ones. A passage that a third of all documents hold is one
row after combining, and one side of a join whose other side is split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import fresh, table
from tidewatch.session import pin, settings, unpin

WINDOW = 4
MIN_WORDS = 25
#: Between lines; nothing is lost, the marks stay with the line they end.
LINE_END = r"(?<=[\n。！？，、；：｡､।۔؟،។။])|(?<=[.!?,;:] )"
#: The same cuts found faster: a mark is put after each line end, then split at.
CUT_AFTER, MARK = r"[\n。！？，、；：｡､।۔؟،។။]|[.!?,;:] ", "\x01"
#: All marks and letters of the patterns above and below beyond ASCII lie here: other texts need neither.
#: Their cuts are a line break, or a mark and a space: one class first, as most characters are in none.
FAR, CUT_AFTER_NEAR = r"[\u0600-\u1FFF\u2E80-\x{10FFFF}]", r"[\n.!?,;:](?:(?<=\n)| )"
#: Letters that count as words, as their scripts put no spaces between words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"
#: A document has fewer lines than 2 to this power.
POSITION_BITS = 28
SPLIT_KEYS = "spark.sql.adaptive.forceOptimizeSkewedJoin"


def is_far(text: Column) -> Column:
    """Whether a text has characters from where the scripts without spaces and their marks are."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.coalesce(F.when(ascii_only, F.lit(False)).otherwise(text.rlike(FAR)), F.lit(False))


def lines_of(text: Column, far: Column | None = None) -> Column:
    """The lines of a text; joined together they are the text. ``far``: ``is_far`` of it, best as a column of its own."""
    whole = F.coalesce(text, F.lit(""))
    far = is_far(whole) if far is None else far
    cut = F.when(far, F.regexp_replace(whole, CUT_AFTER, f"$0{MARK}")).otherwise(
        F.regexp_replace(whole, CUT_AFTER_NEAR, f"$0{MARK}")
    )
    lines = F.when(whole.contains(MARK), F.split(whole, LINE_END)).otherwise(F.split(cut, MARK))
    return F.array_remove(lines, "")


def _with_keys(docs: DataFrame, doc_id: str, text: str, key: str, mark: str) -> DataFrame:
    """``key`` orders documents; rows of one key are told apart by ``mark``."""
    mark_of = F.xxhash64(F.col(text))
    number = F.coalesce(F.col(doc_id).try_cast("long"), F.when(F.col(doc_id).isNotNull(), F.xxhash64(F.col(doc_id))), mark_of)
    return docs.withColumns({key: number, mark: mark_of})


def _hashed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, k, t, line hashes ``h`` and words per line ``w``: one row per document."""
    def spaces(said: Column) -> Column:
        return F.octet_length(said) - F.octet_length(F.replace(said, F.lit(" "), F.lit("")))

    def near(x: Column) -> Column:
        return F.struct(F.xxhash64(x).alias("h"), (spaces(x) + 1).cast("int").alias("w"))

    def distant(x: Column) -> Column:
        letters = F.char_length(x) - F.char_length(F.regexp_replace(x, UNSPACED, ""))
        alone = F.when(F.octet_length(x) == F.char_length(x), F.lit(1)).otherwise(F.greatest(letters, F.lit(1)))
        return F.struct(F.xxhash64(x).alias("h"), (spaces(x) + alone).cast("int").alias("w"))

    rows = _with_keys(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), "id", "text", "k", "t")
    rows = rows.select("id", "k", "t", "text", is_far(F.col("text")).alias("far"))
    rows = rows.select("id", "k", "t", "far", lines_of(F.col("text"), F.col("far")).alias("lines"))
    said = F.transform("lines", lambda x: F.rtrim(x))
    line = F.when(F.col("far"), F.transform(said, distant)).otherwise(F.transform(said, near))
    return rows.select("id", "k", "t", line.alias("line")).select(
        "id", "k", "t", F.col("line.h").alias("h"), F.col("line.w").alias("w")
    )


def _shifted(x: str | Column, by: int) -> tuple[Column, Column]:
    """An array without its last, and without its first ``by`` elements."""
    n = F.greatest(F.size(x) - by, F.lit(0))
    return F.slice(x, 1, n), F.slice(x, by + 1, n)


def _sums(x: str | Column, y: str | Column, by: int) -> Column:
    """Each element of ``x`` plus that of ``y`` ``by`` places on."""
    there = _shifted(y, by)[1]
    return F.zip_with(F.slice(x, 1, F.size(there)), there, lambda a, b: a + b)


def _rows(frame: DataFrame, name: str, values: Column) -> DataFrame:
    """A row for each of ``values`` in place of each row; none for those of an empty or null array.

    The condition is on the new rows: one on ``values`` would be pushed below what they come from and compute it again.
    """
    return frame.select("*", F.explode_outer(values).alias(name)).filter(F.col(name).isNotNull())


def _prints(texts: DataFrame, min_words: int) -> DataFrame:
    """k, p, f: the fingerprints of each document and the lines they begin at.

    Pairs are compared by the top bits of their hash and then by position, as
    one number. Each line is a row that looks at the lines after it in the
    arrays of its document: such steps are compiled, and copy no array, as long
    as no function with a lambda stands among them.
    """
    pairs = F.zip_with(*_shifted("h", 1), lambda a, b: F.xxhash64(a, b))
    lines = texts.select("k", "h", "w", F.size("h").alias("n"), pairs.alias("pairs"))
    lines = _rows(lines, "i", F.when(F.col("n") > 0, F.sequence(F.lit(0), F.col("n") - 1)))

    def pair(j: int) -> Column:
        """The pair that begins ``j`` lines on, null if there is none."""
        at = F.col("i") + j
        top = F.shiftleft(F.shiftrightunsigned(F.get("pairs", at), POSITION_BITS), POSITION_BITS)
        return top.bitwiseOR(at.cast("long"))

    # l0, w0: the line before; l1, w1: the line.
    numbers = range(WINDOW + 1)
    lines = lines.select(
        "k", "h", "pairs", "i", *[pair(j - 1).alias(f"l{j}") for j in numbers], *[F.get("w", F.col("i") + (j - 1)).alias(f"w{j}") for j in numbers]
    )

    def chosen(first: int) -> Column:
        """The smallest pair of the shortest passage from a line on, of WINDOW pairs at most; null if the line suffices."""
        words, least = F.col(f"w{first}"), None
        out = F.when(words.isNull() | (words >= min_words), F.lit(None).cast("long"))
        for k in range(first, first + WINDOW):
            least = F.col(f"l{k}") if least is None else F.least(least, F.col(f"l{k}"))
            if k + 1 < first + WINDOW:
                words = words + F.col(f"w{k + 1}")
                out = out.when(words >= min_words, least)
        return out.when(F.col(f"l{first + WINDOW - 1}").isNotNull(), least)

    lines = lines.select("k", "h", "pairs", "i", (F.col("w1") >= min_words).alias("alone"), chosen(0).alias("u"), chosen(1).alias("v"))
    # A line that is a passage is its own fingerprint; -1 - p tells it from the pair at p.
    # What the line before has chosen is not told again.
    place = F.col("v").bitwiseAND(F.lit((1 << POSITION_BITS) - 1).cast("long")).cast("int")
    told = F.when(F.col("alone"), F.array(-1 - F.col("i"))).when(~F.col("v").eqNullSafe(F.col("u")), F.array(place))
    found = _rows(lines.select("k", "h", "pairs", told.alias("told")), "q", F.col("told"))
    p = F.when(F.col("q") < 0, -1 - F.col("q")).otherwise(F.col("q"))
    return found.select("k", p.alias("p"), F.when(F.col("q") < 0, F.xxhash64(F.get("h", p))).otherwise(F.get("pairs", p)).alias("f"))


def _passages(texts: DataFrame, places: DataFrame, min_words: int) -> DataFrame:
    """k, t, n, ``runs`` (hash, start, end): the shortest passages around ``places`` (k, ps), and the number of lines.

    Rows equal in k and t become one.
    """
    # The fingerprint of what begins at a line is one of the WINDOW pairs from there on.
    about = F.flatten(F.transform("ps", lambda p: F.sequence(F.greatest(p - (WINDOW - 1), F.lit(0)), p)))
    near = texts.select("k", "t", "h", F.col("w").alias("s1")).join(places, "k")
    near = near.select("k", "t", "h", "s1", F.size("h").alias("n"), F.array_distinct(about).alias("starts"))
    # s1, s2, s4, ...: the words of so many lines from each line on.
    strides = [1 << b for b in range((min_words - 1).bit_length())]
    for by in strides[:-1]:
        near = near.select("*", _sums(f"s{by}", f"s{by}", by).alias(f"s{2 * by}"))
    # Per start and for the line after it: the lines whose words do not suffice, by halving strides.
    start = F.col("start")
    rows = _rows(near, "start", F.col("starts"))
    rows = rows.select("*", start.alias("e0"), F.lit(min_words).alias("m0"), (start + 1).alias("e1"), F.lit(min_words).alias("m1"))
    for by in reversed(strides):
        step = {}
        for e, m in (("e0", "m0"), ("e1", "m1")):
            words = F.get(f"s{by}", F.col(e))
            step[e] = F.when(words < F.col(m), F.col(e) + by).otherwise(F.col(e))
            step[m] = F.when(words < F.col(m), F.col(m) - words).otherwise(F.col(m))
        rows = rows.withColumns(step)
    # From each line on: the shortest run, and those that would be too short without it.
    n, short, after = F.col("n"), F.col("e0"), F.col("e1")
    ends = F.when(short < n, F.sequence(short + 1, F.greatest(short + 1, after)))
    rows = _rows(rows.select("k", "t", "n", "h", "start", ends.alias("ends")), "end", F.col("ends"))
    said = F.slice("h", start + 1, F.col("end") - start)
    rows = rows.select("k", "t", "n", F.struct(F.xxhash64(said).alias("g"), "start", "end").alias("run"))
    return rows.groupBy("k", "t").agg(F.max("n").alias("n"), F.sort_array(F.collect_set("run")).alias("runs"))


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``docs``: id, k, t, n_lines and ``gone``, the sorted numbers of its repeated lines.

    Documents come in the order of their id; rows of one id count as one place
    in that order, and rows equal in id and text have the same result. A null
    id is replaced by a hash of the text, one that is no whole number by a hash of it. Null and empty texts have no lines;
    an empty table gives no rows.
    """
    return _repeated(docs, doc_id, text, min_words)[0]


def _repeated(docs: DataFrame, doc_id: str, text: str, min_words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``repeated_lines``, and the pinned tables behind them: lines, and what is gone (k, t, n lines, gone)."""
    texts = pin(_hashed(docs, doc_id, text))
    prints = pin(_prints(texts, min_words))
    shared = prints.groupBy("f").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("f")
    places = prints.join(shared, "f").groupBy("k").agg(F.collect_set("p").alias("ps"))
    # One id may hold many rows: these are split even if they must be gathered once more.
    with settings(docs.sparkSession, {SPLIT_KEYS: "true"}):
        passages = pin(_passages(texts, places, min_words))
    unpin(prints)
    runs = passages.select("k", "t", "n", F.explode("runs").alias("run")).select("k", "t", "n", F.col("run.g").alias("g"), "run")
    firsts = runs.groupBy("g").agg(F.min("k").alias("k0"), F.max("k").alias("k1")).filter("k0 < k1")
    across = runs.join(firsts.select("g", "k0"), "g").filter("k > k0").select("k", "t", "n", "run.start", "run.end")
    # Passages that stand earlier in the same document: the runs are sorted by (hash, start).
    again = F.zip_with(*_shifted("runs", 1), lambda a, b: F.when(a.g == b.g, b))
    within = _rows(passages.select("k", "t", "n", F.array_compact(again).alias("again")), "run", F.col("again"))
    found = across.unionByName(within.select("k", "t", "n", "run.start", "run.end")).distinct()
    found = found.select("k", "t", "n", F.struct("start", "end").alias("run"))
    numbers = F.flatten(F.transform(F.collect_list("run"), lambda r: F.sequence(r.start, r.end - 1)))
    gone = pin(found.groupBy("k", "t").agg(F.max("n").alias("n"), F.sort_array(F.array_distinct(numbers)).alias("gone")))
    unpin(passages)
    sizes = texts.select("id", "k", "t", F.size("h").alias("n_lines"), F.col("w"))
    return sizes.join(gone.drop("n"), ["k", "t"], "left"), texts, gone


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without repeated runs of lines; other columns as they are.

    A document of which every line was a later copy is dropped; one that had no
    line to begin with stays.
    """
    key, mark, lost, count, far = fresh(docs.columns, "k", "t", "gone", "n", "far")
    _, texts, gone = _repeated(docs, doc_id, text, min_words)
    unpin(texts)
    gone = gone.select(F.col("k").alias(key), F.col("t").alias(mark), F.col("gone").alias(lost), F.col("n").alias(count))
    joined = _with_keys(docs, doc_id, text, key, mark).join(gone, [key, mark], "left")
    joined = joined.filter(F.col(lost).isNull() | (F.size(lost) < F.col(count)))
    joined = joined.withColumn(far, F.when(F.col(lost).isNotNull(), is_far(F.col(text))))
    left = F.filter(lines_of(F.col(text), F.col(far)), lambda x, i: ~F.array_contains(lost, i))
    out = joined.withColumn(text, F.when(F.col(lost).isNull(), F.col(text)).otherwise(F.array_join(left, "")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: its lines and the numbers (from 0) of those deleted as later copies."""
    found = repeated_lines(table(spark, sf_dir, "documents"))
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    words = F.aggregate(gone, F.lit(0).cast("long"), lambda s, i: s + F.get("w", i))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_deleted"),
        words.alias("words_deleted"),
        F.array_join(F.transform(gone, lambda i: i.cast("string")), ",").alias("deleted_lines"),
    )
