"""Group spelling variants: words one letter apart, found by matrix products of letter counts in blocks.

One inserted or deleted letter changes a word's letter counts by a squared distance of one, a replaced one by two. Words
lie in blocks of one length, cut further by how many of their letters are in each of a few groups of letters, which a
change moves by one at most: so close words are in the same or in adjacent blocks. A job is a pair of chunks of such
blocks. The product of their count matrices gives all squared distances of the two at once; pairs at most two apart are
verified letter by letter, and what leaves a job is one row for each word that has a near one, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import stored, whole

#: A run of letters, and the capitals that are lowered.
RUN = r"[A-Za-zÀ-ÿ]"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words and letters of a chunk, and letters compared at once.
CHUNK, CHUNK_LETTERS, AT_ONCE = 2048, 1 << 20, 1 << 22


def corpus_words(
    docs: DataFrame, least_length: int = 6, least: int = 5, spoiled: int = 199, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`word, n`: the words of at least so many letters and occurrences, counted over all whole texts.

    A word is a maximal run of letters, A-Z lowered. Where `spoiled` divides the CRC-32 of `<id>:<run>`, the run's letter
    number CRC modulo length is taken out: such occurrences count for what is left. Null text has no words; a null
    identifier is written as nothing.
    """
    run = F.explode(F.regexp_extract_all(whole(text_col), F.lit(f"{RUN}{{{least_length},}}"), 0))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("run"))
    runs = runs.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", CAPITALS, SMALL)).otherwise(F.col("run")))
    runs = runs.withColumn("crc", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("crc") % F.length("run")).cast("int")
    left = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    words = runs.select(F.when(F.col("crc") % spoiled == 0, left).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= least)


def letter_groups(words: DataFrame, many: int) -> list[str]:
    """The letters of the words in so many groups of about the same weight. A row per letter reaches the driver."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(F.count("*").alias("n"))
    groups, loads = [""] * many, [0] * many
    for letter, n in sorted(((r.letter, r.n) for r in letters.filter("letter != ''").collect()), key=lambda x: (-x[1], x[0])):
        k = loads.index(min(loads))
        groups[k] += letter
        loads[k] += n
    return [g for g in groups if g]


def _name(length: Column, inside: list[Column]) -> Column:
    return F.concat_ws(",", length, *inside)


def adjacent(blocks: DataFrame, groups: int) -> DataFrame:
    """`left, left_chunk, right, right_chunk`: every two chunks that may hold words one letter apart, once.
    blocks: `block, length, i0, i1, ..., chunks`. Right words are as long as left ones or a letter longer."""
    inside = [F.col(f"i{k}") for k in range(groups)]

    def moved(length: int, **by: int) -> Column:
        return _name(F.col("length") + length, [c + by.get(f"i{k}", 0) for k, c in enumerate(inside)])

    near = [moved(0)] + [moved(1, **{f"i{k}": 1}) for k in range(groups)]
    near += [moved(0, **{f"i{k}": 1, f"i{j}": -1}) for k in range(groups) for j in range(k + 1, groups)]
    pairs = blocks.select(F.col("block").alias("left"), F.col("chunks").alias("lefts"), F.explode(F.array(*near)).alias("right"))
    pairs = pairs.join(blocks.select(F.col("block").alias("right"), F.col("chunks").alias("rights")), "right")
    pairs = pairs.withColumn("left_chunk", F.explode(F.expr("sequence(0L, lefts - 1)")))
    pairs = pairs.withColumn("right_chunk", F.explode(F.expr("sequence(IF(left = right, left_chunk, 0L), rights - 1)")))
    return pairs.select("left", "left_chunk", "right", "right_chunk")


def _codes(words: list[str]) -> np.ndarray:
    """The code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), len(words[0]))


def _counted(codes: np.ndarray, letters: np.ndarray, kind: type) -> np.ndarray:
    rows = np.repeat(np.arange(len(codes)), codes.shape[1]) * len(letters)
    return np.bincount(rows + np.searchsorted(letters, codes).ravel(), minlength=len(codes) * len(letters)).reshape(len(codes), len(letters)).astype(kind)


def close_counts(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two code matrices whose letter counts are at most a squared distance of two apart: half the distance is
    one matrix product, with the halves of the squared lengths as two more columns. Whole numbers and their halves
    are exact: in single precision below 2**23, else in double."""
    letters = np.unique(np.concatenate([x.ravel(), y.ravel()]))
    kind = np.float32 if y.shape[1] ** 2 < 1 << 22 else np.float64
    a, b = _counted(x, letters, kind), _counted(y, letters, kind)
    squares = [(m * m).sum(axis=1, keepdims=True) / 2 for m in (a, b)]
    half = np.hstack([-a, squares[0], np.ones_like(squares[0])]) @ np.hstack([b, np.ones_like(squares[1]), squares[1]]).T
    return np.nonzero(half <= 1)


def one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether each row of x becomes that of y by one replaced letter, or, if y is a letter longer, by one inserted."""
    n = x.shape[1]
    if y.shape[1] == n:
        return (x != y).sum(axis=1) == 1
    if n == 0:
        return np.ones(len(x), bool)
    ahead, behind = x == y[:, :n], (x == y[:, 1:])[:, ::-1]
    same = [np.where(m.all(axis=1), n, m.argmin(axis=1)) for m in (ahead, behind)]
    return same[0] + same[1] >= n


def near_pairs(left: list[str], right: list[str], alike: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of words one edit apart; `alike`: the two lists are one, and each pair is told once."""
    x, y = _codes(left), _codes(right)
    i, j = close_counts(x, y)
    if alike:
        i, j = i[i < j], j[i < j]
    step = max(1, AT_ONCE // max(1, y.shape[1]))
    kept = [one_edit(x[i[at : at + step]], y[j[at : at + step]]) for at in range(0, len(i), step)]
    keep = np.concatenate(kept) if kept else np.zeros(0, bool)
    return i[keep], j[keep]


def _best(own: list[str], others: list[str], n: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple]:
    """For each word that has near ones: how many, and the one of largest n (ties: smallest)."""
    order = np.lexsort((j, -n[j], i))
    i, j = i[order], j[order]
    kinds, first, times = np.unique(i, return_index=True, return_counts=True)
    return [(own[w], t, int(n[j[f]]), others[j[f]]) for w, f, t in zip(kinds.tolist(), first.tolist(), times.tolist())]


def _jobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["word", "n_near", "form_n", "form"]
    for batch in batches:
        out: list[tuple] = []
        for row in range(batch.num_rows):
            job = batch.slice(row, 1).to_pylist()[0]
            sides = [sorted(zip(job[side], job[f"{side}_n"])) for side in ("words", "others")]
            left, right = ([w for w, _ in side] for side in sides)
            n, m = (np.array([k for _, k in side], np.int64) for side in sides)
            i, j = near_pairs(left, right, job["alike"])
            if len(i):
                if job["alike"]:
                    i, j = np.concatenate([i, j]), np.concatenate([j, i])
                else:
                    out += _best(right, left, n, j, i)
                out += _best(left, right, m, i, j)
            if len(out) >= 1 << 14:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)


def near_words(words: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """`word, n_near, form_n, form` for each word of `word, n` (distinct words, a written table) that has words one edit
    apart: their number, and of these the one of largest n (ties: smallest in code-point order)."""
    total = words.count()
    groups = letter_groups(words, max(1, total.bit_length() - 15))
    inside = [F.length("word") - F.length(F.translate("word", g, "")) for g in groups]
    words = words.select("word", "n", F.length("word").alias("length"), *(c.alias(f"i{k}") for k, c in enumerate(inside)))
    columns = [f"i{k}" for k in range(len(groups))]
    words = words.withColumn("block", _name(F.col("length"), [F.col(c) for c in columns]))
    room = F.greatest(F.lit(1), F.least(F.lit(chunk), F.lit(CHUNK_LETTERS) / F.greatest(F.lit(1), F.col("length"))).cast("long"))
    blocks = words.groupBy("block", "length", *columns).agg(F.count("*").alias("size"))
    blocks = stored(blocks.withColumn("chunks", F.ceil(F.col("size") / room)).drop("size"))
    dealt = words.join(blocks.select("block", "chunks"), "block").withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("chunks")))
    chunks = dealt.groupBy("block", "chunk").agg(F.collect_list(F.struct("word", "n")).alias("all"))
    chunks = stored(chunks.select("block", "chunk", F.col("all.word").alias("words"), F.col("all.n").alias("ns")))
    lefts = chunks.select(F.col("block").alias("left"), F.col("chunk").alias("left_chunk"), "words", F.col("ns").alias("words_n"))
    rights = chunks.select(
        F.col("block").alias("right"), F.col("chunk").alias("right_chunk"), F.col("words").alias("others"), F.col("ns").alias("others_n")
    )
    jobs = adjacent(blocks, len(groups)).join(lefts.hint("merge"), ["left", "left_chunk"])
    jobs = jobs.join(rights.hint("merge"), ["right", "right_chunk"])
    alike = (F.col("left") == F.col("right")) & (F.col("left_chunk") == F.col("right_chunk"))
    found = jobs.select("words", "words_n", "others", "others_n", alike.alias("alike")).mapInArrow(
        _jobs, "word string, n_near long, form_n long, form string"
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")
    )


def roots(forms: DataFrame) -> DataFrame:
    """`word, root` for `word, form`: where following forms ends. Each round doubles how far every word looks ahead; as
    a form is more frequent by a factor, chains are short. Forms must not run in a circle."""
    state = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = stored(state.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        ))
        if state.filter("moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")


def variants(words: DataFrame, ratio: int = 5, chunk: int = CHUNK) -> DataFrame:
    """`word, form, root, n, n_near, form_n` for each row of `word, n` (distinct, n at least one, ratio at least two).

    Two words are near if one inserted, deleted or replaced code point makes one of the other. A word's form is its near
    word of largest n (ties: the smallest in code-point order) if that n is at least `ratio` times its own, else null;
    root is where forms lead, the word itself if there is none. Words of any characters and lengths will do.
    """
    if ratio < 2:
        raise ValueError("ratio must be two or more: forms could run in a circle")
    words = stored(words.select("word", "n"))
    found = words.join(near_words(words, chunk), "word", "left")
    has = F.col("form_n") >= ratio * F.col("n")
    found = stored(found.select(
        "word", F.when(has, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has, F.col("form_n")).alias("form_n"),
    ))
    rooted = found.join(roots(found.filter("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_report(docs: DataFrame) -> DataFrame:
    return variants(corpus_words(docs))


SQL = r"""
WITH RECURSIVE
bytes AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, k:
              CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]{6,}')) AS run FROM documents),
kinds AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY ALL),
coded AS (SELECT run, n, flatten(list_transform(string_split(id || ':' || run, ''), lambda x: CASE
              WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END)) AS b FROM kinds),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x: xor(t[xor(c, x) % 256 + 1], c // 256))) AS h FROM coded, bytes),
spoiled AS (SELECT n, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spoiled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, n, left(word, p) || '*' || substr(word, p + 2) AS swap, left(word, p) || substr(word, p + 2) AS cut
         FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words) t),
apart AS (SELECT word AS long_, cut AS short_ FROM cuts WHERE cut IN (SELECT word FROM words)),
near AS (SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.swap = b.swap AND a.word <> b.word
         UNION SELECT long_, short_ FROM apart UNION SELECT short_, long_ FROM apart),
best AS (SELECT x.word, count(*) AS n_near, arg_min({'form': other, 'n': o.n}, {'n': -o.n, 'form': other}) AS top
         FROM near x JOIN words o ON o.word = x.other GROUP BY x.word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top.n >= 5 * w.n THEN top.form END AS form,
              CASE WHEN top.n >= 5 * w.n THEN top.n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (SELECT word, word AS at FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.at AND e.form IS NULL"""
