"""Route graphs and PageRank."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skylattice.session import cut_lineage, fits_broadcast, lookup_join, materialize

#: Links, own ones included, of a graph that one task ranks.
SMALL_GRAPH = 100_000


def route_edges(df: DataFrame, origin: str, dest: str) -> DataFrame:
    """``src, dst, relationship``: rows per route."""
    return (
        df.filter(F.col(origin).isNotNull() & F.col(dest).isNotNull())
        .groupBy(F.col(origin).alias("src"), F.col(dest).alias("dst"))
        .agg(F.count(F.lit(1)).alias("relationship"))
    )


def vertices(edges: DataFrame) -> DataFrame:
    """``id``: every end of an edge once."""
    return edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()


def page_rank(
    edges: DataFrame,
    reset: float = 0.15,
    tol: float = 0.01,
    max_rounds: int = 200,
    rounds_per_checkpoint: int = 8,
) -> DataFrame:
    """``id, pagerank`` of the distinct edges ``src, dst``; ranks sum to the vertices.

    A vertex passes its last change on along its out-edges as long as the change
    exceeds ``tol``; the ranks are scaled at the end, which gives back the mass
    that vertices without out-edges swallow. Route counts are no weights.

    The links are stored once. In a round the moving vertices that have out-edges
    join the links, which are not shuffled while those vertices are few enough to
    broadcast; changes are summed per target before the shuffle and joined to the state,
    one row per vertex, which is checkpointed. A small graph stays in one task, where
    ``rounds_per_checkpoint`` rounds are one job: the state joins the links and a link
    from each vertex to itself that carries its own values over, so that it is
    read once a round. Rounds beyond the last change add nothing.
    """
    pairs = materialize(edges.select("src", "dst").distinct(), "links")
    degree = pairs.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out"))
    # an end that is null is named, as it is linked to, but has no rank and sends nothing
    linked = vertices(pairs.where("src is not null")).union(vertices(pairs).where("id is not null")).distinct()
    first = F.when(F.col("id").isNotNull(), F.lit(reset))
    state = materialize(
        linked.join(degree, "id", "left").select("id", "out", first.alias("rank"), first.alias("delta")), "state"
    )
    damping = 1.0 - reset
    links = pairs.select("src", "dst", F.lit(False).alias("own")).unionByName(
        state.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(True).alias("own"))
    )
    tiny = fits_broadcast(links, SMALL_GRAPH)
    if tiny:
        links, state = links.coalesce(1), state.coalesce(1)
    few = tiny or fits_broadcast(state.where("out is not null"))
    per_job = rounds_per_checkpoint if tiny else 1
    for done in range(0, max_rounds, per_job):
        for _ in range(min(per_job, max_rounds - done)):
            if tiny:
                state = _round_in_place(state, links, tol, damping)
            else:
                moving = F.when(F.col("delta") > tol, F.col("delta")).otherwise(F.lit(0.0))
                gains = _sent(pairs, state.select("id", "out", moving.alias("push")), "push", damping, few)
                state = state.join(gains, "id", "left").select(
                    "id",
                    "out",
                    (F.col("rank") + F.coalesce("gain", F.lit(0.0))).alias("rank"),
                    F.coalesce("gain", F.lit(0.0)).alias("delta"),
                )
        state = cut_lineage(state)
        total = state.agg(
            F.count_if(F.col("delta") > tol).alias("moving"),
            F.sum("rank").alias("s"),
            F.count(F.lit(1)).alias("n"),
        ).first()
        if total["moving"] == 0:
            break
    else:
        raise RuntimeError(f"no convergence within {max_rounds} rounds")
    scale = total["n"] / total["s"] if total["n"] else 1.0
    return state.select("id", (F.col("rank") * F.lit(scale)).alias("pagerank"))


def _round_in_place(state: DataFrame, links: DataFrame, tol: float, damping: float) -> DataFrame:
    """A round of ``page_rank`` that reads the state once, by ``links`` with an own one per vertex."""
    share = F.when(
        ~F.col("own") & (F.col("delta") > tol), F.col("delta") / F.col("out") * damping
    )
    return (
        links.join(state, links["src"] == state["id"])
        .select(
            F.col("dst").alias("id"),
            F.when(F.col("own"), F.col("out")).alias("out"),
            F.when(F.col("own"), F.col("rank")).alias("rank"),
            share.alias("gain"),
        )
        .groupBy("id")
        .agg(F.max("out").alias("out"), F.max("rank").alias("rank"), F.sum("gain").alias("gain"))
        .select(
            "id",
            "out",
            (F.col("rank") + F.coalesce("gain", F.lit(0.0))).alias("rank"),
            F.coalesce("gain", F.lit(0.0)).alias("delta"),
        )
    )


def _sent(pairs: DataFrame, at: DataFrame, value: str, damping: float, few: bool) -> DataFrame:
    """``id, gain``: what the vertices get if each of ``at`` with out-edges sends ``value`` on."""
    share = at.where(F.col("out").isNotNull() & (F.col(value) != 0)).select(
        F.col("id").alias("src"), (F.col(value) / F.col("out") * damping).alias("gain")
    )
    return (
        pairs.join(F.broadcast(share) if few else share, "src")
        .groupBy(F.col("dst").alias("id"))
        .agg(F.sum("gain").alias("gain"))
    )


def with_page_rank(
    df: DataFrame,
    origin: str,
    dest: str,
    as_of: tuple[str, object] | None = None,
    reset: float = 0.15,
    tol: float = 0.01,
    out: str = "pagerank",
    max_rounds: int = 200,
) -> DataFrame:
    """Add the PageRank of ``origin`` on the route graph of ``df``.

    ``as_of = (column, value)`` builds the graph from rows with a smaller value
    in ``column`` only, so later rows leak nothing into the feature.
    """
    past = df if as_of is None else df.filter(F.col(as_of[0]) < F.lit(as_of[1]))
    ranks = page_rank(route_edges(past, origin, dest), reset, tol, max_rounds)
    named = ranks.select(F.col("id").alias(origin), F.col("pagerank").alias(out))
    kept = [c for c in df.columns if c != out]
    return lookup_join(df.select(*kept), named, [origin], stored=True).select(*kept, out)


def update_page_rank(
    ranks: DataFrame,
    edges: DataFrame,
    reset: float = 0.15,
    tol: float = 0.01,
    max_rounds: int = 200,
) -> tuple[DataFrame, int]:
    """The ranks of changed ``edges``, from ``ranks`` (id, pagerank) of an earlier graph, and the rounds it took.

    The old ranks are scaled to satisfy the new graph on the whole; what each
    vertex then lacks of its equation, or has too much, is its residual. A round
    adds the residuals above ``tol`` to their vertices and sends them on along the
    out-edges, so work and rounds follow the change, not the graph. Vertices that
    are gone drop out, new ones start from nothing. The same ranks as
    ``page_rank`` up to ``tol`` per link of the way.
    """
    pairs = materialize(edges.select("src", "dst").distinct(), "links")
    damping = 1.0 - reset
    degree = pairs.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out"))
    known = ranks.select("id", F.col("pagerank").alias("old"))
    ids = vertices(pairs).join(degree, "id", "left").join(known, "id", "left")
    sized = materialize(ids.select("id", "out", F.coalesce("old", F.lit(0.0)).alias("old")), "ids")
    total = sized.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("old").alias("s"),
        F.sum(F.when(F.col("out").isNotNull(), F.col("old"))).alias("passing"),
    ).first()
    if total["n"] == 0:
        return sized.select("id", F.col("old").alias("pagerank")), 0
    kept = (total["s"] or 0.0) - damping * (total["passing"] or 0.0)
    factor = total["n"] * reset / kept if kept > 0 else 0.0
    start = sized.select("id", "out", (F.col("old") * F.lit(factor)).alias("rank"))

    few = fits_broadcast(sized.where("out is not null"))
    state = materialize(
        start.join(_sent(pairs, start, "rank", damping, few), "id", "left").select(
            "id", "out", "rank",
            (F.lit(reset) + F.coalesce("gain", F.lit(0.0)) - F.col("rank")).alias("residual"),
        ),
        "state",
    )
    moving = F.abs("residual") > tol
    rounds = 0
    while state.where(moving).limit(1).count():
        if rounds >= max_rounds:
            raise RuntimeError(f"no convergence within {max_rounds} rounds")
        rounds += 1
        # both uses read the stored state, of which only the moving vertices send anything
        push = F.when(moving, F.col("residual")).otherwise(F.lit(0.0))
        gains = _sent(pairs, state.select("id", "out", push.alias("push")), "push", damping, few)
        state = cut_lineage(
            state.join(gains, "id", "left").select(
                "id",
                "out",
                (F.col("rank") + push).alias("rank"),
                (F.col("residual") - push + F.coalesce("gain", F.lit(0.0))).alias("residual"),
            )
        )
    # residuals too small to send on still count for their own vertex
    done = state.select("id", (F.col("rank") + F.col("residual")).alias("rank"))
    whole = done.agg(F.sum("rank").alias("s"), F.count(F.lit(1)).alias("n")).first()
    return done.select("id", (F.col("rank") * F.lit(whole["n"] / whole["s"])).alias("pagerank")), rounds
