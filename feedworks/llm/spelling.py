"""Spelling variants, found by a frontier of states in a relational trie.

The vocabulary is kept as a table of trie edges, once for the words and once for the words
read backwards. A state is (word, position, node, edits): so many letters of the word are
read, and the path of the node differs from them by so many edits. In each round all
states are joined to the edges of their nodes, and move on by a letter that agrees, that is
replaced, that is left out of the word or that is put in. Words at the end of a path with one
edit become neighbours.

* Two words one edit apart agree in half of their letters at least, from the front or from the
  back. So the forward search begins in the middle of each word, at the node that is its own
  first half, and the backward one likewise: no state stands near the root.
* A prefix shared by no more than :data:`BUCKET` words is a leaf, and the edge to it lists
  them. A state that gets there compares what is left letter by letter at once. The rounds
  thus follow the depth at which prefixes are shared by more words, not the length of words.
* A node is named by a hash of its prefix. Should two prefixes have one hash, more states
  go on; every neighbour is confirmed on the words themselves, so results don't change.

A node has an edge per letter at most, so a heavy node is no heavy join: Spark splits its states.

Defined results: null text has no words; a null doc_id counts as empty text where runs are
altered; words of equal count are chosen by code point; a word with itself is no pair; no
rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.llm.rows import lower_ascii, text_of

LEAST_LETTERS, LEAST_COUNT = 5, 3
#: One run in so many, by checksum, loses a letter.
DROP_ONE_IN = 97
#: A word stands for its variant if it occurs so many times as often.
FORM_TIMES = 2
#: Words below a leaf of the trie, and levels of the trie that are looked at in one job.
BUCKET, LEVELS = 8, 6

FORWARD, BACKWARD = 0, 1


def word_counts(docs: DataFrame, drop_one_in: int | None = DROP_ONE_IN) -> DataFrame:
    """The words and how often they occur (``n``), rare and short ones left out; written."""
    # Runs only lose letters, so short ones needn't be looked at.
    runs = docs.select(docs["doc_id"].cast("string").alias("doc_id"), lower_ascii(text_of(docs)).alias("text")).select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}"), F.lit(0))).alias("run"))
    word = F.col("run")
    if drop_one_in:
        check = F.crc32(F.concat(F.coalesce("doc_id", F.lit("")), F.lit(":"), "run"))
        at = F.pmod(check, F.char_length("run")).cast("int")
        without = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        word = F.when(check % drop_one_in == 0, without).otherwise(word)
    return workspace.materialise(
        runs.select(word.alias("word")).filter(F.char_length("word") >= LEAST_LETTERS)
        .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT), "spelling_words")


def _node(letters: Column, depth: Column, side: Column) -> Column:
    return F.xxhash64(side, F.substring(letters, F.lit(1), depth))


def _read_both_ways(words: DataFrame) -> DataFrame:
    """Each word twice: ``letters`` as they are, and backwards."""
    ways = F.array(F.struct(F.lit(FORWARD).alias("side"), F.col("word").alias("letters")),
                   F.struct(F.lit(BACKWARD).alias("side"), F.reverse("word").alias("letters")))
    return words.select("word", F.inline(ways)).withColumn("long", F.char_length("letters"))


def leaves(words: DataFrame) -> DataFrame:
    """Per word and side ``leaf``, the depth at which no more than :data:`BUCKET` words share
    its prefix; a letter more than it has where there is none. Depths below two aren't told
    apart. Written."""
    alive, found, top = _read_both_ways(words), [], 1
    while True:
        low, high = top + 1, top + LEVELS
        depths = F.sequence(F.lit(low), F.least(F.lit(high), "long"))
        paths = alive.select("side", "word", F.explode(F.transform(depths, lambda d: F.struct(
            d.alias("depth"), _node(F.col("letters"), d, F.col("side")).alias("node")))).alias("at")).select("side", "word", "at.*")
        inner = workspace.materialise(
            paths.groupBy("node").agg(F.count("*").alias("words")).filter(F.col("words") > BUCKET).select("node", F.lit(True).alias("inner")),
            "spelling_inner")
        reached = workspace.materialise(
            paths.join(inner, "node", "left").groupBy("side", "word").agg(F.min(F.when(F.col("inner").isNull(), F.col("depth"))).alias("leaf")),
            "spelling_leaves")
        reached = reached.withColumn("long", F.char_length("word"))
        further = F.col("leaf").isNull() & (F.col("long") > high)
        found.append(reached.filter(~further).select("side", "word", "long", F.coalesce("leaf", F.col("long") + 1).alias("leaf")))
        rest = reached.filter(further)
        if rest.isEmpty():
            break
        alive = rest.select("side", "word", _letters().alias("letters"), "long")
        top = high
    return workspace.materialise(reduce(DataFrame.unionByName, found), "spelling_trie")


def _letters() -> Column:
    return F.when(F.col("side") == FORWARD, F.col("word")).otherwise(F.reverse("word"))


def edges(trie: DataFrame) -> DataFrame:
    """The edges between depth two and the leaves: ``node``, ``letter``, ``child``, whether it
    is a ``leaf``, and ``words``: all words of a leaf, or the word that ends at the child; written."""
    placed = trie.withColumn("letters", _letters())
    steps = placed.select("word", "letters", "side", "long", "leaf", F.explode(
        F.sequence(F.lit(3), F.least("leaf", "long"))).alias("depth")).filter(F.least("leaf", "long") >= 3)
    # A word is listed at one edge only: that to its leaf, or to its own end.
    ends = F.when(F.col("depth") == F.least("leaf", "long"), F.col("word"))
    return workspace.materialise(
        steps.select(_node(F.col("letters"), F.col("depth") - 1, F.col("side")).alias("node"),
                     F.substring("letters", F.col("depth"), F.lit(1)).alias("letter"),
                     _node(F.col("letters"), F.col("depth"), F.col("side")).alias("child"),
                     (F.col("depth") == F.col("leaf")).alias("is_leaf"), ends.alias("ends"))
        .groupBy("node", "letter", "child").agg(F.bool_or("is_leaf").alias("leaf"), F.collect_list("ends").alias("words")),
        "spelling_edges")


def _one_edit(words: Column, word: Column) -> Column:
    return F.filter(words, lambda other: F.levenshtein(word, other, 1) == 1)


def _states(word, letters, position, node, edits) -> Column:
    return F.struct(word.alias("word"), letters.alias("letters"), position.alias("position"), node.alias("node"),
                    edits.alias("edits"), F.lit(None).cast("string").alias("near"))


def _step(states: DataFrame, trie_edges: DataFrame) -> DataFrame:
    """One level further: the states that follow, and rows with ``near`` for neighbours."""
    word, letters, position, edits = (F.col(c) for c in ("word", "letters", "position", "edits"))
    met = states.join(trie_edges, "node").withColumn("own", F.substring(letters, position + 1, F.lit(1)))
    same = F.col("own") == F.col("letter")
    child = F.col("child")
    go = lambda at, n, unless: F.when(unless, _states(word, letters, at, child, n))
    on = F.array_compact(F.array(
        go(position + 1, edits, same),
        go(position + 1, F.lit(1), (edits == 0) & ~same & (position < F.char_length(letters))),
        go(position, F.lit(1), edits == 0)))
    near = F.transform(_one_edit(F.col("words"), word), lambda other: F.struct(
        word.alias("word"), F.lit(None).cast("string").alias("letters"), F.lit(None).cast("int").alias("position"),
        F.lit(None).cast("long").alias("node"), F.lit(None).cast("int").alias("edits"), other.alias("near")))
    # A leaf ends the search below it, whatever is left of the word.
    moved = met.filter((edits == 0) | same).select(F.inline(F.concat(F.when(~F.col("leaf"), on).otherwise(F.slice(on, 1, 0)), near)))
    left_out = states.filter((edits == 0) & (position < F.char_length(letters))).select(
        "word", "letters", (position + 1).alias("position"), "node", F.lit(1).alias("edits"), F.lit(None).cast("string").alias("near"))
    return moved.unionByName(left_out)


def neighbours(words: DataFrame) -> DataFrame:
    """All pairs of words one edit apart, both ways round: ``word``, ``near``; written."""
    trie = leaves(words)
    trie_edges = edges(trie)
    # The middle, so that either the letters before an edit or those behind it are half a word.
    middle = F.when(F.col("side") == FORWARD, F.floor(F.col("long") / 2)).otherwise(F.ceil(F.col("long") / 2)).cast("int")
    placed = trie.withColumn("letters", _letters()).withColumn("middle", middle)
    begun = placed.filter("leaf > middle").select(
        "word", "letters", F.col("middle").alias("position"), _node(F.col("letters"), F.col("middle"), F.col("side")).alias("node"),
        F.lit(0).alias("edits"), F.lit(None).cast("string").alias("near"))
    # Words whose first half is in a leaf already.
    listed = placed.filter("leaf <= long").select(_node(F.col("letters"), F.col("leaf"), F.col("side")).alias("node"), "word", "leaf", "middle")
    leaf_words = listed.groupBy("node").agg(F.collect_list("word").alias("words"))
    found = [workspace.materialise(
        listed.filter("leaf <= middle").join(leaf_words, "node")
        .select("word", F.explode(_one_edit(F.col("words"), F.col("word"))).alias("near")), "spelling_near")]
    states = workspace.materialise(begun, "spelling_states")
    while not states.isEmpty():
        reached = workspace.materialise(_step(states, trie_edges), "spelling_states")
        found.append(reached.filter("near IS NOT NULL").select("word", "near"))
        # A word read to its end, with its edit spent, has been looked up on the way.
        states = reached.filter("near IS NULL AND NOT (edits = 1 AND position >= char_length(letters))")
    return workspace.materialise(reduce(DataFrame.unionByName, found).distinct(), "spelling_pairs")


def _roots(forms: DataFrame) -> DataFrame:
    """The last form that each word leads to. ``forms`` is a written table of word and form."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        # Counts double along forms, so chains are short, and each round halves them.
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = workspace.materialise(roots.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling_roots")
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return roots


def variant_groups(docs: DataFrame) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n. See the module."""
    words = word_counts(docs)
    pairs = neighbours(words)
    others = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (pairs.join(others, "near").groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    known = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.less") >= FORM_TIMES * F.col("n"), F.col("best")).alias("best"))
    known = workspace.materialise(known.select(
        "word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n")), "spelling_known")
    roots = _roots(workspace.materialise(known.filter("form IS NOT NULL").select("word", "form"), "spelling_forms"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
