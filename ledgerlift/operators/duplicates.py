"""Near-duplicate names of persons and companies.

Work runs on distinct names, never on pairs of rows. A rule flags every row for which an
earlier row matches, and names the earliest such row; further rows with the same name add
nothing but repetition, so the output grows with the rows and not with their pairs. The
distinct-name pairs behind the fuzzy rule are available from ``similar_names``.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.similarity import edit_budget, similarity
from ledgerlift.functions.text import name_tokens, percent_text, strip_space
from ledgerlift.operators.checks import findings_from
from ledgerlift.operators.skew import join_to_groups
from ledgerlift.schemas import COMPANY_SUFFIXES, DOMAINS, NAME_THRESHOLD, PERSON_TITLES
from ledgerlift.sources.stages import stage, unstage

HOT_GRAMS = 4096
GRAMS_PER_KEY = 2
# no two different names of which one is shorter reach a threshold that check_threshold accepts
LEAST_LENGTH = 4
BLOCK_LETTERS = 3
PART_NAMES = 1000  # names of one signature that a task compares with as many others
PAIRS_PER_TASK = 4_000_000
KEYS_PER_NAME = 40  # subsequences per name up to which they are the cheaper keys
MOST_KEYS = 2000  # subsequences that one name may be written under
OFTEN = 200  # names of a signature that are compared with each other


def name_rows(df: DataFrame, row_id: str, name: str, drop: Sequence[str], trim: bool = True) -> DataFrame:
    """(id, name, shown, raw, norm, first, last, words); rows without a usable name are left out.

    ``raw`` is the lower-cased name the fuzzy rule compares, ``norm`` the joined tokens.
    NULL names belong to the completeness check; names made of titles or suffixes only
    have no token left and match nothing.
    """
    tokens = name_tokens(F.col("name"), drop)
    shown = strip_space(F.col("name")) if trim else F.col("name")
    return (
        df.select(F.col(row_id).alias("id"), F.col(name).alias("name"))
        .filter(F.col("id").isNotNull() & F.col("name").isNotNull())
        .select("id", "name", shown.alias("shown"), tokens.alias("tokens"))
        .select(
            "id", "name", "shown", F.lower("shown").alias("raw"),
            F.array_join("tokens", " ").alias("norm"),
            F.try_element_at("tokens", F.lit(1)).alias("first"),
            F.try_element_at("tokens", F.lit(-1)).alias("last"),
            F.size("tokens").alias("words"),
        )
        .filter(F.trim("norm") != "")
    )


def person_rows(df: DataFrame, row_id: str = "employee_id", name: str = "name") -> DataFrame:
    return name_rows(df, row_id, name, PERSON_TITLES)


def company_rows(df: DataFrame, row_id: str = "vendor_id", name: str = "vendor_name") -> DataFrame:
    """Distinct (id, name) first: many orders name the same vendor."""
    return name_rows(df.select(row_id, name).distinct(), row_id, name, COMPANY_SUFFIXES, trim=False)


def staged_names(rows: DataFrame) -> tuple[DataFrame, int]:
    """The name rows written once, for the several rules that read them, and their number."""
    written = stage(rows, "name-rows")
    return written, written.count()


# --- rule 1: equal normalised names -------------------------------------------


def exact_groups(rows: DataFrame) -> DataFrame:
    """One row per normalised name: earliest id, its name and the number of rows."""
    return rows.groupBy("norm").agg(
        F.min("id").alias("first_id"), F.min_by("shown", "id").alias("first_name"),
        F.count(F.lit(1)).alias("n"),
    )


def exact_matches(rows: DataFrame, known: int | None = None) -> DataFrame:
    """(id, shown, other_id, other_name): every row but the first of its normalised name."""
    groups = exact_groups(rows).filter(F.col("n") > 1)
    return (
        join_to_groups(rows.select("id", "shown", "norm"), groups, "norm", "n", "id", known)
        .filter(F.col("id") > F.col("first_id"))
        .select("id", "shown", F.col("first_id").alias("other_id"), F.col("first_name").alias("other_name"))
    )


# --- rule 2: surname shortened to an initial ------------------------------------


def is_abbreviation(first_a: Column, last_a: Column, words_a: Column,
                    first_b: Column, last_b: Column, words_b: Column) -> Column:
    short_a = (F.length(last_a) == 1) & last_b.startswith(last_a)
    short_b = (F.length(last_b) == 1) & last_a.startswith(last_b)
    return ((first_a == first_b) & (words_a >= 2) & (words_b >= 2)
            & (last_a != last_b) & (short_a | short_b))


def initial_keyed(rows: DataFrame) -> DataFrame:
    """Rows keyed by (first token, first letter of the last token) and their side of the rule.

    Within a key, every shortened name matches every full one and nothing else does.
    """
    return rows.filter((F.col("words") >= 2) & (F.length("last") >= 1)).withColumn(
        "hub", F.concat_ws("\u001f", "first", F.substring("last", 1, 1))
    ).withColumn("is_short", F.length("last") == 1)


def initial_groups(rows: DataFrame) -> DataFrame:
    """Per key with both sides present: earliest row and row count of each side."""
    keyed = initial_keyed(rows)
    short, full = F.col("is_short"), ~F.col("is_short")
    sides = keyed.groupBy("hub").agg(
        F.min(F.when(short, F.struct("id", "shown"))).alias("short"),
        F.min(F.when(full, F.struct("id", "shown"))).alias("full"),
        F.count_if(short).alias("short_rows"),
        F.count_if(full).alias("full_rows"),
    )
    return sides.filter((F.col("short_rows") > 0) & (F.col("full_rows") > 0)).withColumn(
        "n", F.col("short_rows") + F.col("full_rows"))


def abbreviation_matches(rows: DataFrame, known: int | None = None) -> DataFrame:
    """(id, shown, other_id, other_name): rows with an earlier row on the other side."""
    keyed = initial_keyed(rows).select("id", "shown", "hub", "is_short")
    other = F.when(F.col("is_short"), F.col("full")).otherwise(F.col("short"))
    return (
        join_to_groups(keyed, initial_groups(rows), "hub", "n", "id", known)
        .select("id", "shown", other.alias("other"))
        .filter(F.col("id") > F.col("other.id"))
        .select("id", "shown", F.col("other.id").alias("other_id"), F.col("other.shown").alias("other_name"))
    )


# --- rule 3: similar names --------------------------------------------------------


def name_keys(rows: DataFrame, known: int | None = None) -> DataFrame:
    """Distinct compared names with their earliest row (``head``) and latest id.

    ``free`` is the earliest row that is not the first row of its normalised name: pairs
    with that first row already belong to rule 1.
    """
    keys = rows.groupBy("raw").agg(
        F.first("norm").alias("norm"), F.first("first").alias("first"), F.first("last").alias("last"),
        F.first("words").alias("words"),
        F.min(F.struct("id", "shown")).alias("head"), F.max("id").alias("last_id"),
        F.count(F.lit(1)).alias("n"),
    )
    second = (
        join_to_groups(rows.select("id", "shown", "raw", "norm"),
                       exact_groups(rows).filter(F.col("n") > 1), "norm", "n", "id", known)
        .filter(F.col("id") > F.col("first_id"))
        .groupBy("raw").agg(F.min(F.struct("id", "shown")).alias("free"))
    )
    # written once: every later step reads the distinct names, and their size is known
    return stage(keys.join(second, "raw", "left"), "names")


def _shared_floor(length: Column, threshold: float) -> Column:
    """Fewest bigrams a name of this length shares with any partner at the threshold.

    Two names at insert/delete distance k have a common subsequence of (a+b-k)/2
    characters. Its bigrams lose at most one per edit in either name, so (a+b-k)/2-1-k
    bigrams are shared; the floor is the least of that over all lengths a partner can have.
    """
    lo = F.ceil(length * threshold / (2 - threshold) - 1e-9).cast("int")
    hi = F.floor(length * (2 - threshold) / threshold + 1e-9).cast("int")

    def shared(m: Column) -> Column:
        k = edit_budget(length, m, threshold)
        floor = ((length + m - k) / 2).cast("int") - 1 - k
        return F.when(k >= F.abs(length - m), floor)

    return F.array_min(F.transform(F.sequence(lo, hi), shared))


def check_threshold(threshold: float) -> None:
    """Refuse thresholds at which sharing two bigrams is no longer certain."""
    for length in range(2, 400):
        for partner in range(length, int(length * (2 - threshold) / threshold + 1e-9) + 1):
            k = _edits(length, partner, threshold)
            shared = (length + partner - k) // 2 - 1 - k
            if k >= partner - length and k > 0 and shared < GRAMS_PER_KEY:
                raise ValueError(f"threshold {threshold} is too low to find every pair through shared bigrams")


def candidate_keys(names: DataFrame, threshold: float) -> DataFrame:
    """(raw, block, prefix, sig): signatures such that any two names over the threshold share one.

    Prefix filtering over numbered bigrams in one global order, rare ones first: names
    that share at least m bigrams share two within their first (count - m + 2). The order
    knows the 4096 most frequent bigrams, a fixed number, and treats the rest as rare, so
    wide-spread pieces such as a common suffix end up outside the prefix. A signature is
    the pair of two prefix bigrams, each hashed together with the block: a collision only
    adds a candidate that the score rejects.
    """
    gram_list = F.transform(F.sequence(F.lit(1), F.length("raw") - 1), lambda i: F.col("raw").substr(i, F.lit(2)))
    numbered = F.transform(
        F.col("grams"),
        lambda g, i: F.concat(
            g, F.size(F.filter(F.slice(F.col("grams"), 1, i + 1), lambda x: x == g)).cast("string")),
    )
    grams = (
        names.filter(F.length("raw") >= LEAST_LENGTH)
        .withColumn("grams", gram_list).withColumn("grams", numbered)
    )
    hot = (
        grams.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
        .orderBy(F.col("df").desc(), "gram").limit(HOT_GRAMS)
    )
    ranked = (
        grams.select("raw", "block", F.explode("grams").alias("gram"))
        .join(F.broadcast(hot), "gram", "left")
        .groupBy("raw", "block")
        # bounded by the length of one name
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram"))).alias("g"))
    )
    keep = F.greatest(F.size("g") - _shared_floor(F.length("raw"), threshold) + GRAMS_PER_KEY,
                      F.lit(GRAMS_PER_KEY))
    prefix = F.transform(F.slice("g", 1, keep), lambda s: F.xxhash64(F.col("block"), s["gram"]))
    pairs = F.flatten(F.transform(
        F.col("prefix"),
        lambda x, i: F.transform(
            F.slice(F.col("prefix"), i + 2, F.size("prefix")), lambda y: F.array(x, y)),
    ))
    return ranked.select("raw", "block", prefix.alias("prefix")).select("raw", "block", "prefix", F.explode(pairs).alias("sig"))


def _edits(a: int, b: int, threshold: float) -> int:
    """``edit_budget`` of two lengths."""
    k = int((1.0 - threshold) * (a + b) + 1e-9)
    return k - (a + b - k) % 2


def length_pairs(lengths: Collection[int], threshold: float) -> list[tuple[int, int, int]]:
    """(a, b, common) for every two of the lengths, a <= b, that different names at the threshold can have.

    Two such names have a common subsequence of ``common`` characters.
    """
    ordered, out = sorted(n for n in lengths if n >= LEAST_LENGTH), []
    for i, a in enumerate(ordered):
        for b in ordered[i:]:
            if b > a * (2 - threshold) / threshold + 1e-9:
                break
            k = _edits(a, b, threshold)
            if k > 0 and k >= b - a:
                out.append((a, b, (a + b - k) // 2))
    return out


def subsequences(text: Column, cuts: Column) -> Column:
    """The distinct texts that are left when ``cuts`` characters are taken out of ``text``."""
    def one_less(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(s)),
                           lambda i: F.concat(s.substr(F.lit(1), i - 1), s.substr(i + 1, F.length(s))))

    cut = F.aggregate(F.sequence(F.lit(1), cuts), F.array(text),
                      lambda made, _: F.array_distinct(F.flatten(F.transform(made, one_less))))
    return F.when(cuts == 0, F.array(text)).otherwise(cut)


def _compared(placed: DataFrame, threshold: float, metric: str, part_names: int) -> DataFrame:
    """(raw_1, raw_2) of names that share a key of the written table ``placed(key, raw, ...)`` and are near enough.

    The names of a key are cut into parts of about ``part_names``, and every pair of parts
    i <= j is a cell that one task compares: a key on very many names becomes a triangle of
    cells, each of bounded size, and a name is sent once to each part of its keys and once
    more. With ``sig`` and ``prefix`` a pair is taken at the first signature its names share only.
    """
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    seen = sizes.agg(F.sum(F.col("n").cast("double") * F.col("n") / 2).alias("work"), F.max("n").alias("most")).first()
    # few bytes but much work per row: tasks follow the pairs to compare, not the bytes
    tasks = max(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((seen["work"] or 0.0) / PAIRS_PER_TASK))
    if (seen["most"] or 0) > part_names:
        large = sizes.filter(F.col("n") > part_names).select("key", F.ceil(F.col("n") / part_names).cast("int").alias("parts"))
        placed = placed.join(large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        dealt = placed.withColumn("part", F.pmod(F.xxhash64("raw"), F.col("parts")).cast("int"))
        a = dealt.withColumns({"i": F.col("part"), "j": F.explode(F.sequence("part", F.col("parts") - 1))}).drop("part", "parts")
        b = dealt.withColumns({"i": F.explode(F.sequence(F.lit(0), "part")), "j": F.col("part")}).drop("part", "parts")
        cell = ["key", "i", "j"]
    else:
        a, b, cell = placed, placed, ["key"]
    a, b = (side.repartition(tasks, *cell).alias(name) for side, name in ((a, "a"), (b, "b")))
    length_a, length_b = F.length("a.raw"), F.length("b.raw")
    budget = edit_budget(length_a, length_b, threshold)
    # replacing a character counts once by edit distance and twice by inserts and deletes
    most = F.floor((1.0 - threshold) * (length_a + length_b) / 2 + 1e-9).cast("int") if metric == "levenshtein" else budget
    met = reduce(lambda x, y: x & y, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in cell])
    met = met & ((F.col("a.i") < F.col("a.j")) | (F.col("a.raw") < F.col("b.raw")) if len(cell) > 1 else F.col("a.raw") < F.col("b.raw"))
    met = met & (F.abs(length_a - length_b) <= budget)
    if "prefix" in placed.columns:
        # the prefixes of both names are in one global order, so either side may come first
        met = met & (F.col("a.sig") == F.slice(F.array_intersect("a.prefix", "b.prefix"), 1, GRAMS_PER_KEY))
    return a.join(b, met & F.call_function("levenshtein", F.col("a.raw"), F.col("b.raw"), most).between(0, most)).select(
        F.least("a.raw", "b.raw").alias("raw_1"), F.greatest("a.raw", "b.raw").alias("raw_2"))


def near_names(names: DataFrame, threshold: float, part_names: int = PART_NAMES, metric: str = "ratio",
               keys_per_name: int = KEYS_PER_NAME, often: int = OFTEN) -> DataFrame:
    """(raw_1, raw_2): distinct names of one block within the edit distance of the threshold.

    Which names can be near follows from their lengths (``length_pairs``), and such names
    share a subsequence, a key that hardly any other names share. Lengths with few of these
    keys per name (``keys_per_name``) meet by them. The names of other lengths meet at a
    signature of rare bigrams (``candidate_keys``); where one is on more than ``often`` names
    that number would grow with the table, so these names meet by the subsequences too.
    Only names with more than ``MOST_KEYS`` of them, long ones, are compared all the same.
    """
    spark = names.sparkSession
    names = names.withColumn("size", F.length("raw"))
    # one row per length
    counts = {r["size"]: r["n"] for r in names.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    few, some, many = [], [], []
    for a, b, common in length_pairs(counts, threshold):
        keys = {n: math.comb(n, common) for n in (a, b)}
        if max(keys.values()) > MOST_KEYS:
            many.append((a, b, common))
        else:
            cost = sum(counts[n] * k for n, k in keys.items())
            (few if cost <= keys_per_name * sum(counts[n] for n in keys) else some).append((a, b, common))

    def by_size(pairs: list[tuple[int, int, int]], columns: str) -> DataFrame:
        rows = sorted({(n, *p) for p in pairs for n in p[:2]})
        return F.broadcast(spark.createDataFrame(rows, "size int, a int, b int, common int").select("size", *columns.split()).distinct())

    wanted, found = names.join(by_size(few, "common"), "size").select("raw", "block", "common"), []
    if some or many:
        sig = stage(candidate_keys(names.join(by_size(some + many, ""), "size", "left_semi"), threshold), "name-signatures")
        hot = sig.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > often).select("sig")
        hot_sig = stage(sig.join(hot, "sig", "left_semi").withColumn("size", F.length("raw")), "hot-signatures")
        wanted = wanted.unionByName(
            hot_sig.select("raw", "block", "size").distinct().join(by_size(some, "common"), "size").select("raw", "block", "common"))
        rare = sig.join(hot, "sig", "left_anti").select(F.xxhash64("sig").alias("key"), "raw", "sig", "prefix")
        found.append(_compared(stage(rare, "rare-signatures"), threshold, metric, part_names))
        if many:
            cells = hot_sig.join(by_size(many, "a b"), "size").select(F.xxhash64("sig", "a", "b").alias("key"), "raw", "sig", "prefix")
            found.append(_compared(stage(cells, "long-names"), threshold, metric, part_names))
    if few or some:
        made = wanted.distinct().select("raw", F.explode(F.transform(
            subsequences(F.col("raw"), F.length("raw") - F.col("common")), lambda s: F.xxhash64(F.col("block"), s))).alias("key"))
        found.append(_compared(stage(made, "name-keys"), threshold, metric, part_names))
    if not found:
        return names.select(F.col("raw").alias("raw_1"), F.col("raw").alias("raw_2")).limit(0)
    # dealt by the column that is joined next
    return reduce(DataFrame.unionByName, found).repartition("raw_1").distinct()


def similar_names(keys: DataFrame, threshold: float = NAME_THRESHOLD, metric: str = "ratio",
                  blocked: bool = True) -> DataFrame:
    """Directed pairs of distinct names (earlier name first) with a score at or over the threshold.

    ``keys`` comes from ``name_keys``. A direction is kept when some row of the
    first name comes before some row of the second. Nothing is lost against comparing all
    pairs: the candidate join, the length bound and the edit distance are implied by the
    threshold. Blocked pairs also agree in the first three letters of the first token.
    """
    check_threshold(threshold)
    block = F.substring("first", 1, BLOCK_LETTERS) if blocked else F.lit("")
    names = keys.withColumn("block", block).select("raw", "block")
    near = near_names(names, threshold, metric=metric)
    sides = keys.select("raw", "norm", "first", "last", "words", "head", "free", "last_id")
    pair = (
        near.join(sides.select(F.col("raw").alias("raw_1"), F.struct(*sides.columns).alias("x")), "raw_1")
        .join(sides.select(F.col("raw").alias("raw_2"), F.struct(*sides.columns).alias("y")), "raw_2")
    )
    directed = pair.select(F.explode(F.array(
        F.struct(F.col("x").alias("early"), F.col("y").alias("late")),
        F.struct(F.col("y").alias("early"), F.col("x").alias("late")),
    )).alias("p")).select("p.*").filter(F.col("early.head.id") < F.col("late.last_id"))
    scored = directed.withColumn("score", similarity(F.col("early.raw"), F.col("late.raw"), metric))
    return scored.filter(F.col("score") >= threshold)


@dataclass(frozen=True)
class NameLinks:
    """Name rows, their number, the distinct names and the similar pairs among them, each written once.

    The fuzzy findings, the clusters and the review read the same pairs, so the similarity
    join runs once.
    """

    rows: DataFrame
    known: int
    keys: DataFrame
    pairs: DataFrame | None


def name_links(rows: DataFrame, threshold: float = NAME_THRESHOLD, metric: str = "ratio", blocked: bool = True,
               fuzzy: bool = True) -> NameLinks:
    written, known = staged_names(rows)
    keys = name_keys(written, known)
    pairs = None
    if fuzzy:
        found = similar_names(keys, threshold, metric, blocked)
        pairs = stage(found, "similar-names")
        unstage(found, "name-signatures", "hot-signatures", "rare-signatures", "long-names", "name-keys", "compared-names")
    return NameLinks(written, known, keys, pairs)


def fuzzy_matches(rows: DataFrame, threshold: float = NAME_THRESHOLD, metric: str = "ratio",
                  blocked: bool = True, abbreviations: bool = True, known: int | None = None,
                  links: NameLinks | None = None) -> DataFrame:
    """(id, shown, other_id, other_name, score): rows with a similar earlier row that no earlier rule has flagged.

    A row appears once, against the earliest such row: the minimum over the similar names
    is taken before any row is joined, so the output grows with the rows.
    """
    keys = links.keys if links else name_keys(rows, known)
    pairs = links.pairs if links else similar_names(keys, threshold, metric, blocked)
    e, l = F.col("early"), F.col("late")
    same_norm = e["norm"] == l["norm"]
    if abbreviations:
        pairs = pairs.filter(~is_abbreviation(
            e["first"], e["last"], e["words"], l["first"], l["last"], l["words"]))
    other = F.when(same_norm, e["free"]).otherwise(e["head"])
    across = pairs.select(l["raw"].alias("raw"), other.alias("other"), "score")
    # a name repeated beyond the pairs of rule 1 is its own similar name
    own = keys.filter(F.col("free.id") < F.col("last_id")).select(
        "raw", F.col("free").alias("other"), F.lit(1.0).alias("score"))
    earliest = across.unionByName(own).filter(F.col("other").isNotNull()).groupBy("raw").agg(
        F.min(F.struct("other", "score")).alias("t")).select("raw", "t.other", "t.score")
    targets = earliest.join(keys.select("raw", "n"), "raw")
    return (
        join_to_groups(rows.select("id", "shown", "raw"), targets, "raw", "n", "id", known)
        .filter(F.col("id") > F.col("other.id"))
        .select("id", "shown", F.col("other.id").alias("other_id"),
                F.col("other.shown").alias("other_name"), "score")
    )


# --- findings ---------------------------------------------------------------------


def person_exact_findings(rows: DataFrame, known: int | None = None) -> DataFrame:
    d = DOMAINS["hr"]
    text = F.concat(F.lit("Name '"), F.col("shown"), F.lit("' matches "), F.col("other_id"), F.lit(" ('"),
                    F.col("other_name"), F.lit("') exactly once whitespace/case differences are ignored - "
                                               "likely the same person entered twice."))
    return findings_from(exact_matches(rows, known), d.label, d.table, "name", "id",
                         "duplication", text, "high", "exact_name_match")


def person_abbreviation_findings(rows: DataFrame, known: int | None = None) -> DataFrame:
    d = DOMAINS["hr"]
    text = F.concat(F.lit("Name '"), F.col("shown"), F.lit("' appears to abbreviate the surname on "),
                    F.col("other_id"), F.lit(" ('"), F.col("other_name"),
                    F.lit("') to an initial - likely the same person entered twice."))
    return findings_from(abbreviation_matches(rows, known), d.label, d.table, "name", "id",
                         "duplication", text, "medium", "name_abbreviation")


def person_fuzzy_findings(rows: DataFrame, threshold: float = NAME_THRESHOLD, metric: str = "ratio",
                          known: int | None = None, links: NameLinks | None = None) -> DataFrame:
    d = DOMAINS["hr"]
    text = F.concat(F.lit("Name '"), F.col("shown"), F.lit("' is a "), percent_text(F.col("score")),
                    F.lit(" textual match to "), F.col("other_id"), F.lit(" ('"), F.col("other_name"),
                    F.lit("') - possible duplicate entry."))
    return findings_from(fuzzy_matches(rows, threshold, metric, known=known, links=links), d.label, d.table, "name", "id",
                         "duplication", text, "medium", "fuzzy_name_match")


def vendor_names(procurement: DataFrame) -> DataFrame:
    """(vendor_id, vendor_name, po_id): the names in use with their first order.

    One pass over the orders; every vendor rule can read this instead of the orders.
    """
    return procurement.groupBy("vendor_id", "vendor_name").agg(F.min("po_id").alias("po_id"))


def vendor_orders(procurement: DataFrame) -> DataFrame:
    """``vendor_names`` with ``name_orders``, the number of orders of each name: all that the vendor rules and clusters read."""
    return procurement.groupBy("vendor_id", "vendor_name").agg(
        F.min("po_id").alias("po_id"), F.count(F.lit(1)).alias("name_orders"))


def first_orders(procurement: DataFrame) -> DataFrame:
    """(vendor_id, first_po): the order that stands for a vendor, partially aggregated."""
    return procurement.groupBy("vendor_id").agg(F.min("po_id").alias("first_po"))


def _on_first_order(matches: DataFrame, procurement: DataFrame) -> DataFrame:
    orders = first_orders(procurement).withColumnRenamed("vendor_id", "id")
    return matches.join(orders, "id", "left").withColumn("row", F.coalesce("first_po", "id"))


def company_suffix_findings(rows: DataFrame, procurement: DataFrame, known: int | None = None) -> DataFrame:
    d = DOMAINS["procurement"]
    on_orders = _on_first_order(exact_matches(rows, known), procurement)
    text = F.concat(F.lit("Vendor '"), F.col("shown"), F.lit("' ("), F.col("id"), F.lit(") matches '"),
                    F.col("other_name"), F.lit("' ("), F.col("other_id"),
                    F.lit(") once common company suffixes (Ltd/PLC/Inc/etc.) are ignored - likely the "
                          "same vendor entered as two master records."))
    return findings_from(on_orders, d.label, d.table, "vendor_name", "row", "duplication", text, "high",
                         "company_suffix_match")


def company_fuzzy_findings(rows: DataFrame, procurement: DataFrame, threshold: float = NAME_THRESHOLD,
                           metric: str = "ratio", known: int | None = None, links: NameLinks | None = None) -> DataFrame:
    d = DOMAINS["procurement"]
    matches = fuzzy_matches(rows, threshold, metric, blocked=False, abbreviations=False, known=known, links=links)
    on_orders = _on_first_order(matches, procurement)
    text = F.concat(F.lit("Vendor '"), F.col("shown"), F.lit("' ("), F.col("id"), F.lit(") is a "),
                    percent_text(F.col("score")), F.lit(" textual match to '"), F.col("other_name"),
                    F.lit("' ("), F.col("other_id"), F.lit(") - possible duplicate vendor master record."))
    return findings_from(on_orders, d.label, d.table, "vendor_name", "row", "duplication", text, "medium",
                         "fuzzy_name_match")
