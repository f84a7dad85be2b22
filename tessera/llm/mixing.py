"""Mixing sources to target weights: hierarchical budgeting over a domain - language - source tree.

A token budget runs down the tree.  At every node it is shared among the
children by their weights; a child that cannot use its share (its subtree holds
fewer tokens, times the epochs allowed) takes all it can, and what it leaves is
shared again among its siblings by weight, until none is short.  A node's
capacity is the sum over its subtree, so a shortage is settled among siblings
and goes up to the ancestors' siblings only as far as the whole subtree is
short.  Shares are whole tokens (largest remainder, ties by name) and add up
exactly.

Every leaf then reads seeded epochs: epoch ``e`` orders its documents by
``md5(seed:e:id)``.  Whole epochs are taken while the leaf's budget lasts, and
of the next epoch the prefix of documents that start before the remaining
tokens; the last of them gives only the tokens still needed.

Everything is DataFrame expressions.  The prefix is cut without sorting a
leaf: tokens are summed per leaf and the first three hex digits of the order
key, running sums over these at most 4096 cells find the cell of the cut, and
only that cell's documents are ordered - a source with a third of all rows is
one more set of cells.  The tree is a parameter, so joins with it are
broadcast by a proven bound.

Names that the tree does not hold (new or null ones) share one branch
:data:`OTHER` at their level: a domain beside the named ones, a language in its
domain, a source in its language, each with the weight that :class:`Others`
states.  So every row belongs to a leaf, and there are no more leaves than the
tree has nodes.

Defined results: a null domain, language or source counts as an unnamed one;
null and empty texts have no token and ride along when their place lies in the
prefix; rows that share an id (a null id is one id) are drawn together; an
empty table gives an empty result; columns of the input may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written

LEVELS = ("domain", "lang", "source")
#: The branch of names that the tree does not hold.
OTHER = "(other)"


@dataclass(frozen=True)
class Leaf:
    """A leaf of the tree with the integer weights of its domain, of its language there and of its source there."""

    domain: str
    lang: str
    source: str
    domain_weight: int
    lang_weight: int
    source_weight: int


@dataclass(frozen=True)
class Others:
    """Weights of the branches of unnamed domains, languages and sources."""

    domain: int = 5
    lang: int = 5
    source: int = 1


def words(text_col: str = "text") -> Column:
    """Tokens of a text: maximal runs without ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _share(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Deal ``budget`` (per parent, at most the children's capacity) to the children.

    ``children``: the parent's columns, ``name``, ``weight``, ``cap`` and the parent's ``budget``;
    returns them with ``budget`` replaced by the child's own.
    """
    big = "decimal(38,0)"
    by_need = Window.partitionBy(*parent).orderBy(F.col("cap").cast("double") / F.col("weight"), name)
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    open_ = children.where("weight > 0").withColumns({
        "_taken": F.coalesce(F.sum("cap").over(before), F.lit(0).cast("long")),
        "_passed": F.coalesce(F.sum("weight").over(before), F.lit(0).cast("long")),
        "_all": F.sum("weight").over(whole),
    })
    short = F.col("cap").cast(big) * (F.col("_all") - F.col("_passed")).cast(big) <= (
        (F.col("budget") - F.col("_taken")).cast(big) * F.col("weight").cast(big)
    )
    dealt = open_.withColumn("_short", short).withColumns({
        "_rest": F.col("budget") - F.coalesce(F.sum(F.when(F.col("_short"), F.col("cap"))).over(whole), F.lit(0)),
        "_left": F.col("_all") - F.coalesce(F.sum(F.when(F.col("_short"), F.col("weight"))).over(whole), F.lit(0)),
    })
    product = F.col("_rest").cast(big) * F.col("weight").cast(big)
    dealt = dealt.withColumns({
        "_floor": F.when(F.col("_short"), F.col("cap")).otherwise(F.floor(product / F.greatest("_left", F.lit(1)).cast(big)).cast("long")),
        "_over": F.when(~F.col("_short"), (product % F.greatest("_left", F.lit(1)).cast(big))),
    })
    by_rest = whole.orderBy(F.col("_over").desc_nulls_last(), name)
    spare = F.col("budget") - F.sum("_floor").over(whole)
    dealt = dealt.withColumn("_spare", spare).withColumn("_turn", F.row_number().over(by_rest))
    return dealt.withColumn(
        "budget", F.col("_floor") + F.when(~F.col("_short") & (F.col("_turn") <= F.col("_spare")), 1).otherwise(0)
    ).select(*parent, name, "weight", "cap", "budget")


def with_others(tree: list[Leaf], others: Others = Others()) -> list[Leaf]:
    """The tree with a branch for unnamed names at every level."""
    domains = {x.domain: x.domain_weight for x in tree}
    langs = {(x.domain, x.lang): x.lang_weight for x in tree}
    more = [Leaf(d, lang, OTHER, domains[d], w, others.source) for (d, lang), w in langs.items()]
    more += [Leaf(d, OTHER, OTHER, w, others.lang, others.source) for d, w in domains.items()]
    return [*tree, *more, Leaf(OTHER, OTHER, OTHER, others.domain, others.lang, others.source)]


def allocate(stats: DataFrame, tree: list[Leaf], budget_percent: int, max_epochs: int) -> DataFrame:
    """``domain, lang, source, tokens, budget`` per leaf of the tree that has tokens.

    ``stats``: ``domain, lang, source, tokens``; the budget is ``budget_percent`` of all tokens
    of the leaves, at most what the tree can give.
    """
    spark = stats.sparkSession
    named = spark.createDataFrame(
        [(x.domain, x.lang, x.source, x.domain_weight, x.lang_weight, x.source_weight) for x in tree],
        "domain string, lang string, source string, w1 long, w2 long, w3 long",
    )
    leaves = written(
        stats.join(F.broadcast(named), list(LEVELS)).where("tokens > 0 and w1 > 0 and w2 > 0 and w3 > 0")
        .withColumn("cap", F.col("tokens") * max_epochs),
        "leaves",
    )
    langs = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"), F.max("w2").alias("weight"), F.max("w1").alias("w1"))
    domains = langs.groupBy("domain").agg(F.sum("cap").alias("cap"), F.max("w1").alias("weight"))
    root = leaves.agg(
        F.least(F.floor(F.sum("tokens").cast("decimal(38,0)") * budget_percent / 100).cast("long"), F.sum("cap")).alias("budget")
    ).first()[0] or 0
    top = _share(domains.withColumns({"root": F.lit(0), "budget": F.lit(root).cast("long")}), ["root"], "domain")
    middle = _share(langs.drop("w1").join(F.broadcast(top.select("domain", "budget")), "domain"), ["domain"], "lang")
    low = leaves.withColumn("weight", F.col("w3")).select(*LEVELS, "weight", "cap")
    low = _share(low.join(F.broadcast(middle.select("domain", "lang", "budget")), ["domain", "lang"]), ["domain", "lang"], "source")
    return written(
        leaves.select(*LEVELS, "tokens").join(F.broadcast(low.select(*LEVELS, "budget")), list(LEVELS)), "budgets"
    )


def _labelled(docs: DataFrame, tree: list[Leaf], labels: list[Column], kept: list[Column]) -> DataFrame:
    """The ``kept`` columns of every row and its leaf; names that the tree does not hold become :data:`OTHER`.

    The name lists come from the tree parameter, so the joins are broadcast by a proven bound.
    """
    spark = docs.sparkSession
    rows = docs.select(*kept, *[c.cast("string").alias(f"_{n}") for c, n in zip(labels, LEVELS, strict=True)])
    for k, level in enumerate(LEVELS, 1):
        # the path down to this level, where the tree has it; below an unnamed name nothing is named
        held = sorted({(x.domain, x.lang, x.source)[:k] for x in tree})
        path = [*LEVELS[: k - 1], f"_{level}"]
        known = spark.createDataFrame([(*p, p[-1]) for p in held], ", ".join(f"{c} string" for c in [*path, level])) if held else None
        rows = rows.join(F.broadcast(known), path, "left").withColumn(level, F.coalesce(level, F.lit(OTHER))) if held else rows.withColumn(level, F.lit(OTHER))
    return rows.drop(*[f"_{n}" for n in LEVELS])


def _order_key(seed: int, epoch, ident) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(ident.cast("string"), F.lit("null"))))


def _cuts(slim: DataFrame, budgets: DataFrame, seed: int) -> DataFrame:
    """Per leaf with a budget: ``epochs`` taken whole, and the last place of the next one, ``cut_key, cut_id, cut_start``.

    ``slim``: ``domain, lang, source, id`` (string) and ``n_tokens``.
    """
    plan = budgets.where("budget > 0").withColumn("epochs", F.expr("budget div tokens")).withColumn(
        "rest", F.col("budget") - F.col("epochs") * F.col("tokens")
    )
    keyed = slim.join(F.broadcast(plan), list(LEVELS)).withColumn("key", _order_key(seed, F.col("epochs"), F.col("id")))
    keyed = keyed.where("rest > 0").withColumn("cell", F.substring("key", 1, 3))
    cells = keyed.groupBy(*LEVELS, "cell").agg(F.sum("n_tokens").alias("n"), F.max("rest").alias("rest"))
    upto = Window.partitionBy(*LEVELS).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = cells.withColumn("start", F.sum("n").over(upto) - F.col("n")).where("start < rest and start + n >= rest")
    hit = hit.select(*LEVELS, "cell", "start")  # one cell per leaf
    units = (
        keyed.join(F.broadcast(hit), [*LEVELS, "cell"])
        .groupBy(*LEVELS, "key", "id", "rest").agg(F.sum("n_tokens").alias("n"), F.max("start").alias("start"))
    )
    within = Window.partitionBy(*LEVELS).orderBy("key", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = units.withColumn("place", F.col("start") + F.sum("n").over(within) - F.col("n")).where("place < rest")
    last = placed.groupBy(*LEVELS).agg(F.max(F.struct("key", "id", "place")).alias("cut"))
    return plan.join(F.broadcast(last), list(LEVELS), "left").select(
        *LEVELS, "budget", "epochs", "rest", F.col("cut.key").alias("cut_key"), F.col("cut.id").alias("cut_id"), F.col("cut.place").alias("cut_start")
    )


def draw(
    docs: DataFrame, tree: list[Leaf], domain: Column, budget_percent: int = 100, max_epochs: int = 4, seed: int = 7,
    id_col: str = "doc_id", lang_col: str = "lang", source_col: str = "source", tokens: Column | None = None, others: Others = Others(),
) -> DataFrame:
    """One row per input row: id, leaf, ``n_tokens, leaf_budget, epochs`` taken whole, ``partial`` (in the next one's
    prefix), ``partial_tokens`` and ``drawn_tokens``.  Leaves without budget draw nothing."""
    tokens = words() if tokens is None else tokens
    labels = [domain, F.col(lang_col), F.col(source_col)]
    slim = written(_labelled(docs, tree, labels, [F.col(id_col).alias("_id"), tokens.alias("n_tokens")]), "tokens")
    cuts = _plan(slim, tree, others, budget_percent, max_epochs, seed)
    found = slim.join(F.broadcast(cuts), list(LEVELS), "left")
    key, ident = _order_key(seed, F.col("epochs"), F.col("_id")), F.coalesce(F.col("_id").cast("string"), F.lit("null"))
    at_cut = (key == F.col("cut_key")) & (ident == F.col("cut_id"))
    inside = _inside(key, ident)
    taken = F.when(~inside, 0).when(at_cut, F.least(F.col("n_tokens"), F.col("rest") - F.col("cut_start"))).otherwise(F.col("n_tokens"))
    epochs = F.coalesce("epochs", F.lit(0).cast("long"))
    return found.select(
        F.col("_id").alias(id_col), *LEVELS, "n_tokens", F.coalesce("budget", F.lit(0).cast("long")).alias("leaf_budget"),
        epochs.alias("epochs"), inside.alias("partial"), taken.cast("long").alias("partial_tokens"),
        (epochs * F.col("n_tokens") + taken).cast("long").alias("drawn_tokens"),
    )


def _inside(key: Column, ident: Column) -> Column:
    """Does the row's place lie in the prefix of the epoch that is not taken whole?"""
    return F.coalesce((key < F.col("cut_key")) | ((key == F.col("cut_key")) & (ident <= F.col("cut_id"))), F.lit(False))


def _plan(slim: DataFrame, tree: list[Leaf], others: Others, budget_percent: int, max_epochs: int, seed: int) -> DataFrame:
    stats = slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    budgets = allocate(stats, with_others(tree, others), budget_percent, max_epochs)
    ids = slim.select(*LEVELS, F.coalesce(F.col("_id").cast("string"), F.lit("null")).alias("id"), "n_tokens")
    return written(_cuts(ids, budgets, seed), "cuts")


def mix(
    docs: DataFrame, tree: list[Leaf], domain: Column, budget_percent: int = 100, max_epochs: int = 4, seed: int = 7,
    id_col: str = "doc_id", lang_col: str = "lang", source_col: str = "source", tokens: Column | None = None, others: Others = Others(),
    whole_epochs: int = 0,
) -> DataFrame:
    """The mixture: every row of ``docs`` as often as it is drawn, whole, columns unchanged; copies follow each other.

    With ``whole_epochs`` every row comes that often first, and the budget (``budget_percent`` of all tokens) is a
    surplus dealt by weight, which takes a leaf to ``max_epochs`` epochs in all at most.
    The cut document of a leaf is kept whole, so a leaf exceeds its budget by less than one document.
    The rows are not shuffled: the decision joins the (broadcast) leaf plan and the row's own order key.
    """
    tokens = words() if tokens is None else tokens
    labels = [domain, F.col(lang_col), F.col(source_col)]
    slim = written(_labelled(docs, tree, labels, [F.col(id_col).alias("_id"), tokens.alias("n_tokens")]), "tokens")
    cuts = _plan(slim, tree, others, budget_percent, max_epochs - whole_epochs, seed)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = _labelled(docs, tree, labels, [row, F.col(id_col).alias("_id")]).join(F.broadcast(cuts), list(LEVELS), "left")
    key, ident = _order_key(seed, F.col("epochs"), F.col("_id")), F.coalesce(F.col("_id").cast("string"), F.lit("null"))
    times = F.lit(whole_epochs) + F.coalesce(F.col("epochs").cast("int"), F.lit(0)) + _inside(key, ident).cast("int")
    return found.select("row", F.explode(F.array_repeat(F.lit(1), times)).alias("_copy")).select("row.*")


def shares(docs: DataFrame, tree: list[Leaf], domain: Column, lang_col: str = "lang", source_col: str = "source", tokens: Column | None = None) -> DataFrame:
    """``domain, lang, source, tokens, share``: what each leaf has of the tokens of a table (of a mixture, say)."""
    tokens = words() if tokens is None else tokens
    leaves = _labelled(docs, tree, [domain, F.col(lang_col), F.col(source_col)], [tokens.alias("n")]).groupBy(*LEVELS).agg(F.sum("n").alias("tokens"))
    return leaves.select("*", (F.col("tokens") / F.sum("tokens").over(Window.partitionBy(F.lit(0)))).alias("share"))  # a row per leaf of the tree
