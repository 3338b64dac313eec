"""Secret scan with DataFrame functions only: fixed shapes, and sliding-window entropy.

Three fixed shapes are searched: assignments to names like `password`, access key ids, and long
hexadecimal runs. Besides, every run of 20 or more characters of the base64 alphabets is a
candidate: a window slides over it, character counts are updated by the one that
enters and the one that leaves, and the Shannon entropy follows from their sum of n log n. Each class
of characters has its own limit, which one in 200 windows of evenly drawn characters misses (LIMITS);
longer runs have more windows and are missed less. A candidate whose best window reaches the
limit is a span, unless the allow-list fits: numbers, UUIDs, stated examples, and runs made of
words (of one case, capitalised or in camel case) and numbers between separators. Words with digits
elsewhere than at the end are allowed below BASE64_LIMIT only. So random letters of a single case
are not found: their entropy is that of long words in prose.

Positions come from the lengths of the parts between matches, summed in order within a text.
Texts themselves are never shuffled, only matches. NULL and empty texts have no spans; NULL and
repeated ids keep one row for each input row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

# The shapes and their least lengths.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "entropy")

HEX_ALPHABET = "0123456789abcdef"
BASE64_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_="
RUN = "[A-Za-z0-9+/_=-]"
CANDIDATE = f"{RUN}{{20,}}"
WINDOW = 20
#: 0.5 % quantiles of the entropy of WINDOW random characters, 300,000 draws each, rounded down.
LIMITS = (
    ("^([a-z0-9]+|[A-Z0-9]+)$", 3.34),  # 36 characters
    ("^[A-Za-z]+$", 3.52),              # 52
    ("^[A-Za-z0-9]+$", 3.58),           # 62
)
HEX_LEAST, REST_LEAST = 2.82, 3.60      # 16; 64
#: Parts that a run of words consists of; without any it is empty.
_SHORT = "|".join("As At By Do Id If In Is It My No Of On Or To Up".split())
PART = f"(?:[A-Z]?[a-z]+|[A-Z]+|[a-z]*(?:[A-Z][a-z]{{2,}}|{_SHORT}){{1,40}})[0-9]{{0,4}}|[0-9]{{1,8}}"
PARTS = f"(?<![A-Za-z0-9])(?:{PART})(?![A-Za-z0-9])|[-_/=+]+"
DIGITS_INSIDE = "[0-9][^0-9]|[0-9]{5}"  # elsewhere than a few at the end
BASE64_LIMIT = 3.9                      # of runs of words with such digits
ALLOWED = (
    r"^[0-9]+$",                                              # numbers
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",  # UUIDs
    r"^[A-Za-z]+([-_/=+]+[A-Za-z]+)*[-_/=+]*[0-9]{0,4}$",     # words in a row, perhaps numbered
    r"(?i)example|sample|dummy|placeholder|xxxxxx|000000",    # stated to be no secret; fillers
)


def _n_log_n(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


def window_entropy(run: Column, alphabet: str, width: int = WINDOW) -> Column:
    """Greatest Shannon entropy (bits) of any `width` neighbouring characters. One pass over the
    characters keeps a count for each of the alphabet and changes two of them at a time."""
    letters = F.lit(alphabet)
    code = lambda at: F.instr(letters, F.substr(run, at, F.lit(1))) - 1
    first = F.substr(run, F.lit(1), F.lit(width))
    counts = F.transform(F.split(letters, ""), lambda c: F.lit(width) - F.length(F.replace(first, c, F.lit(""))))
    total = F.aggregate(counts, F.lit(0.0), lambda s, n: s + _n_log_n(n))
    start = F.struct(counts.alias("counts"), total.alias("sum"), total.alias("least"))

    def slide(state: Column, at: Column) -> Column:
        leaves, enters = code(at), code(at + width)
        out, came = state["counts"][leaves], state["counts"][enters]
        change = F.when(leaves == enters, F.lit(0.0)).otherwise(
            _n_log_n(out - 1) - _n_log_n(out) + _n_log_n(came + 1) - _n_log_n(came))
        now = state["sum"] + change
        moved = F.transform(state["counts"], lambda n, i: n - F.when(i == leaves, 1).otherwise(0)
                            + F.when(i == enters, 1).otherwise(0))
        return F.struct(moved.alias("counts"), now.alias("sum"), F.least(state["least"], now).alias("least"))

    steps = F.when(F.length(run) > width, F.sequence(F.lit(1), F.length(run) - width)).otherwise(
        F.array().cast("array<int>"))
    return F.lit(math.log2(width)) - F.aggregate(steps, start, slide, lambda s: s["least"]) / width


def suspicious(run: Column) -> Column:
    """Whether a candidate's entropy reaches its class's limit and no allow-list pattern fits."""
    words = F.regexp_replace(run, PARTS, "") == ""
    fits = words & ~run.rlike(DIGITS_INSIDE)
    for pattern in (ALLOWED[0], ALLOWED[1], ALLOWED[3]):
        fits = fits | run.rlike(pattern)
    limit = F.when(words, BASE64_LIMIT)
    for shape, least in LIMITS:
        limit = limit.when(run.rlike(shape), least)
    return F.when(fits, False).when(
        run.rlike("^[0-9A-Fa-f]+$"), window_entropy(F.lower(run), HEX_ALPHABET) >= HEX_LEAST).otherwise(
        window_entropy(run, BASE64_ALPHABET) >= limit.otherwise(REST_LEAST))


def find_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, spans): for every row the spans (start, order, kind, end), sorted; code points,
    end exclusive. `order` is the kind's place in KINDS."""
    patterns = (ASSIGN, ACCESS, HEX, CANDIDATE)
    texts = docs.select(F.col(id_column).alias("_id"), F.monotonically_increasing_id().alias("_row"),
                        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("_text"))
    found = texts.select("_id", "_row", "_text", *(
        F.regexp_extract_all("_text", F.lit(p), F.lit(0)).alias(f"_m{i}") for i, p in enumerate(patterns)))
    parted = found.select("_id", "_row", F.filter(F.array(*(
        F.struct(F.lit(i).alias("order"), F.col(f"_m{i}").alias("matches"), F.when(
            F.size(f"_m{i}") > 0, F.transform(F.split("_text", p, -1), F.length)).alias("gaps"))
        for i, p in enumerate(patterns))), lambda k: F.size(k["matches"]) > 0).alias("_kinds"))
    each = parted.select("_id", "_row", F.explode_outer("_kinds").alias("_kind")).select(
        "_id", "_row", F.col("_kind.order").alias("order"),
        F.posexplode_outer(F.arrays_zip("_kind.matches", "_kind.gaps")).alias("_at", "_part"))
    # the part after the last match has no match; rows of a text stay together from here on
    within = Window.partitionBy("_row", "order").orderBy("_at")
    ended = F.sum(F.col("_part.gaps") + F.coalesce(F.length("_part.matches"), F.lit(0))).over(within)
    placed = (each.repartition("_row").withColumn("end", ended.cast("long"))
              .withColumn("start", F.col("end") - F.length("_part.matches")))
    match = F.col("_part.matches")
    valid = F.when(F.col("order") == 0, F.length(F.regexp_extract(match, ASSIGN, 1)) >= ASSIGN_LEAST).when(
        F.col("order") == 3, suspicious(match)).otherwise(F.lit(True))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("order") + 1)
    span = F.when(match.isNotNull() & valid, F.struct("start", "order", kind.alias("kind"), "end"))
    return (placed.groupBy("_row").agg(F.first("_id").alias(id_column), F.sort_array(
        F.collect_list(span)).alias("spans")).drop("_row"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    count = lambda order: F.size(F.filter("spans", lambda s: s["order"] == order)).cast("long")
    base = F.filter("spans", lambda s: s["order"] < 3)
    return find_spans(docs, id_column, text_column).select(
        id_column, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
           mark: str = "<secret>") -> DataFrame:
    """The input's rows and columns with every span of the fixed shapes, and every candidate of high
    entropy, replaced by a mark. Works text by text, without a shuffle.

    Assigned values go first, then candidates, each at its own place and as a whole, so a key inside a
    longer one leaves nothing behind; a run that goes on from an assigned value is judged without it. Access
    ids and hexadecimal runs are parts of candidates, and go last where those were none."""
    text = F.col(text_column)
    cut = F.regexp_replace(text, f"(?i:(password|passwd|secret|token|api_?key))([\"']?\\x20*[:=]\\x20*[\"']?)"
                                 f"[A-Za-z0-9+/_.=-]{{{ASSIGN_LEAST},}}", f"$1$2{mark}")
    gaps, runs = F.split(cut, CANDIDATE, -1), F.regexp_extract_all(cut, F.lit(CANDIDATE), F.lit(0))
    judged = F.transform(runs, lambda r: F.when(suspicious(r), F.lit(mark)).otherwise(r))
    # a gap before each run and one at the end
    cut = F.array_join(F.transform(F.arrays_zip(gaps.alias("gap"), judged.alias("run")),
                                   lambda p: F.concat(F.coalesce(p["gap"], F.lit("")), F.coalesce(p["run"], F.lit("")))), "")
    cut = F.regexp_replace(cut, HEX, mark)  # before access ids: both may hold the same digits
    clean = F.regexp_replace(cut, f"{ACCESS}|AKIA[A-Z0-9]*(?={mark})", mark)
    return docs.withColumn(text_column, F.when(text.isNull(), text).otherwise(clean))
