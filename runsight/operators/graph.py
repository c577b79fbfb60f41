"""Job dependency graph as DataFrames.

The graph is an edge table (parent -> child).  Reachability is a transitive
closure table (anc, job, hops) built by path doubling: each round joins the
closure with itself, so a chain of depth D needs about log2(D) rounds.  The
driver only runs the loop and reads two numbers per round; the pairs stay on
the executors, and every round is checkpointed to the shared checkpoint folder
so lineage stays short and a lost executor recomputes one round only.

Cause search does not need the closure: ``ancestors_of`` searches upwards from the jobs of interest only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from runsight.session import scratch_dir

ARROW = " → "  # separator of the displayed chain: " → "


def edges(registry: DataFrame) -> DataFrame:
    """G1: parent -> child edges from ``depends_on`` (self loops and duplicates dropped)."""
    return (registry.select(F.explode("depends_on").alias("parent"), F.col("job_name").alias("child"))
            .filter(F.col("parent").isNotNull() & (F.col("parent") != F.col("child")))
            .dropDuplicates(["parent", "child"]))


def nodes(registry: DataFrame) -> DataFrame:
    """All jobs, isolated ones included (``explode_outer`` keeps jobs without parents)."""
    named = registry.select(F.col("job_name").alias("node"))
    parents = registry.select(F.explode_outer("depends_on").alias("node")).filter(F.col("node").isNotNull())
    return named.unionByName(parents).distinct()


def _materialize(df: DataFrame, tag: str, *metrics):
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it back.

    One job per call: the observed metrics come with the write.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, tag)
    obs = Observation(tag)
    df.observe(obs, *metrics).write.parquet(path)
    return spark.read.parquet(path), obs.get


def closure(edges_df: DataFrame, max_rounds: int = 64) -> DataFrame:
    """All (anc, job) pairs with the fewest hops between them.

    Path doubling: after s squarings the table holds every pair whose shortest
    path has at most 2^s hops.  A sub-path of a shortest path is itself shortest,
    so once the longest pair found is below 2^s nothing longer exists and the
    loop stops (about log2(depth) squarings, two per round).  Each round is one written table in the
    shared checkpoint folder; its pair count and longest path come back through
    ``observe``.  Pairs (x, x) only arise from cycles and are dropped (see ``cycles``).
    """
    c, st = _materialize(
        edges_df.select(F.col("parent").alias("anc"), F.col("child").alias("job"), F.lit(1).alias("hops"))
        .groupBy("anc", "job").agg(F.min("hops").alias("hops")), "closure0",
        F.count(F.lit(1)).alias("n"), F.max("hops").alias("mx"))
    if st["n"] == 0:
        return c

    def square(x):
        a, b = x.alias("a"), x.alias("b")
        step = (a.join(b, F.col("a.job") == F.col("b.anc"))
                .select(F.col("a.anc").alias("anc"), F.col("b.job").alias("job"),
                        (F.col("a.hops") + F.col("b.hops")).alias("hops")))
        return x.unionByName(step).groupBy("anc", "job").agg(F.min("hops").alias("hops"))

    squarings = 0
    for i in range(1, max_rounds + 1):
        # two squarings per written table: half the jobs, same stop rule per squaring
        c, st = _materialize(square(square(c)), f"closure{i}", F.count(F.lit(1)).alias("n"),
                             F.max("hops").alias("mx"))
        squarings += 2
        if st["mx"] < 2 ** squarings:
            return c.filter(F.col("anc") != F.col("job"))
    raise RuntimeError("closure did not converge; raise max_rounds")


#: Hops of the short cuts that the search jumps by, and rounds after which they are doubled (for very deep graphs).
JUMP, PATIENCE = 4, 4


def _compose(a: DataFrame, b: DataFrame) -> DataFrame:
    """(job, anc, hops): ``a`` followed by ``b``, upwards."""
    x, y = a.alias("x"), b.alias("y")
    return x.join(y, F.col("x.anc") == F.col("y.job")).select(
        F.col("x.job").alias("job"), F.col("y.anc").alias("anc"), (F.col("x.hops") + F.col("y.hops")).alias("hops"))


def _nearest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("job", "anc").agg(F.min("hops").alias("hops"))


def ancestors_of(sources: DataFrame, edges_df: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(anc, job, hops) of the ancestors of ``sources`` (column job_name) only, each job itself included with 0 hops.

    A breadth-first search from all sources at once over short cuts of up to JUMP hops.  The pairs found are the visited
    set; once they hold every ancestor within h hops, whoever is farther is reached through a pair at exactly h hops, so
    only those are the frontier.  A round is two jumps, one written table; the search ends when no pair lies at the
    frontier.  After PATIENCE rounds the short cuts are doubled each round, so a chain of depth D takes about log2(D) rounds.
    The work follows the ancestors of the sources, not the pairs of the graph.
    """
    one = edges_df.select(F.col("child").alias("job"), F.col("parent").alias("anc"), F.lit(1).alias("hops"))
    two = _nearest(one.unionByName(_compose(one, one)))
    cuts, _ = _materialize(_nearest(two.unionByName(_compose(two, two))), "short-cuts", F.count(F.lit(1)).alias("n"))
    found = sources.select(F.col("job_name").alias("job")).distinct().select(
        "job", F.col("job").alias("anc"), F.lit(0).alias("hops"))
    jump, reached = JUMP, 0
    for i in range(max_rounds):
        for _ in range(2):
            found = _nearest(found.unionByName(_compose(found.filter(F.col("hops") == reached), cuts)))
            reached += jump
        found, st = _materialize(found, f"search{i}", F.max("hops").alias("mx"))
        if st["mx"] is None or st["mx"] < reached:
            return found.select("anc", "job", "hops")
        if i >= PATIENCE:
            cuts, _ = _materialize(_nearest(cuts.unionByName(_compose(cuts, cuts))), f"short-cuts{i}",
                                   F.count(F.lit(1)).alias("n"))
            jump *= 2
    raise RuntimeError("search did not end; raise max_rounds")


def ancestor_counts(closure_df: DataFrame, all_nodes: DataFrame | None = None) -> DataFrame:
    """Number of ancestors of every job (0 for roots when ``all_nodes`` is given)."""
    n = closure_df.groupBy("job").agg(F.count_if(F.col("anc") != F.col("job")).alias("n_ancestors"))
    if all_nodes is None:
        return n.withColumnRenamed("job", "job_name")
    return (all_nodes.select(F.col("node").alias("job")).join(n, "job", "left")
            .select(F.col("job").alias("job_name"), F.coalesce("n_ancestors", F.lit(0)).cast("long")
                    .alias("n_ancestors")))


def unrelated_slow(targets: DataFrame, slow: DataFrame, closure_df: DataFrame) -> DataFrame:
    """For each target job, slow jobs that are neither itself, an ancestor nor a descendant.

    total_slow - related_slow, with related counted from the closure: no
    slow x slow pairing.  Jobs missing from the graph are related to nothing.
    """
    closure_df = closure_df.filter(F.col("anc") != F.col("job"))
    s = slow.select(F.col("job_name").alias("s")).distinct()
    n_slow = s.agg(F.count(F.lit(1))).scalar()
    t = targets.select("job_name").distinct()
    up = (closure_df.join(s, closure_df.anc == s.s).select(F.col("job").alias("job_name"), "s"))
    down = (closure_df.join(s, closure_df.job == s.s).select(F.col("anc").alias("job_name"), "s"))
    self_ = t.join(s, t.job_name == s.s).select("job_name", "s")
    related = (up.unionByName(down).unionByName(self_).join(t, "job_name", "left_semi")
               .groupBy("job_name").agg(F.count_distinct("s").alias("related")))
    return (t.join(related, "job_name", "left")
            .select("job_name", (n_slow - F.coalesce("related", F.lit(0))).alias("unrelated_slow")))


def slow_ancestors(targets: DataFrame, slow: DataFrame, closure_df: DataFrame) -> DataFrame:
    """(job_name, anc) where anc is a slow ancestor of a target job."""
    s = slow.select(F.col("job_name").alias("anc")).distinct()
    return (closure_df.filter(F.col("anc") != F.col("job")).join(targets.select(F.col("job_name").alias("job")).distinct(), "job")
            .join(s, "anc").select(F.col("job").alias("job_name"), "anc"))


def cascade_root(targets: DataFrame, slow: DataFrame, closure_df: DataFrame, counts: DataFrame,
                 mode: str = "nearest") -> DataFrame:
    """The slow ancestor with the most ancestors ("nearest") or the fewest ("origin").

    Ties go to the greater name (nearest) or the smaller name (origin).
    """
    sa = slow_ancestors(targets, slow, closure_df).join(
        counts.select(F.col("job_name").alias("anc"), "n_ancestors"), "anc", "left")
    key = F.struct(F.coalesce("n_ancestors", F.lit(0)), "anc")
    pick = F.max_by("anc", key) if mode == "nearest" else F.min_by("anc", key)
    if mode not in ("nearest", "origin"):
        raise ValueError("mode must be 'nearest' or 'origin'")
    return sa.groupBy("job_name").agg(pick.alias("root"), F.count(F.lit(1)).alias("slow_ancestors"))


def shortest_paths(pairs: DataFrame, reach: DataFrame, edges_df: DataFrame | None = None) -> DataFrame:
    """Shortest path root -> job as "a → b → c" for each (root, job_name) pair.

    ``reach`` holds (anc, job, hops) for all ancestors of the pairs' jobs.  Every ancestor of a job keeps a pointer to its
    smallest-named child that is one hop nearer to the job, so the chain follows real edges also when several shortest
    paths tie; one join finds all pointers.  The pointers of one job are then followed from its root within a row:
    no table per level.  Pairs without a path get the two-node fallback "root → job".
    """
    if edges_df is None:
        edges_df = reach.filter(F.col("hops") == 1).select(F.col("anc").alias("parent"), F.col("job").alias("child"))
    p = pairs.select("root", "job_name").distinct()
    r = reach.filter(F.col("hops") > 0).select(F.col("job").alias("job_name"), F.col("anc").alias("node"), "hops")
    ends = p.join(r.select("job_name", F.col("node").alias("root"), F.col("hops").alias("D")), ["root", "job_name"], "left")
    near = r.join(ends.groupBy("job_name").agg(F.max("D").alias("D")), "job_name").filter(F.col("hops") <= F.col("D"))
    step = near.join(edges_df.select(F.col("parent").alias("node"), F.col("child").alias("next")), "node")
    # the child is the job itself, or an ancestor one hop nearer
    inner = step.filter(F.col("hops") > 1).join(
        r.select("job_name", F.col("node").alias("next"), (F.col("hops") + 1).alias("hops")), ["job_name", "next", "hops"])
    last = step.filter((F.col("hops") == 1) & (F.col("next") == F.col("job_name")))
    cols = ["job_name", "node", "next"]
    pointers = (inner.select(cols).unionByName(last.select(cols)).groupBy("job_name", "node")
                .agg(F.min("next").alias("next")).groupBy("job_name")
                .agg(F.map_from_entries(F.collect_list(F.struct("node", "next"))).alias("to")))
    path = F.aggregate(F.sequence(F.lit(1), F.col("D")), F.array("root"),
                       lambda path, _: F.array_append(path, F.element_at(F.col("to"), F.element_at(path, -1))))
    return (ends.join(pointers, "job_name", "left")
            .select("root", "job_name", F.col("D").alias("hops"),
                    F.coalesce(F.when(F.col("D").isNotNull(), F.array_join(path, ARROW)),
                               F.concat_ws(ARROW, "root", "job_name")).alias("chain")))


def impacted(slow: DataFrame, closure_df: DataFrame) -> DataFrame:
    """Blast radius: descendants of each slow job."""
    s = slow.select(F.col("job_name").alias("anc")).distinct()
    return (s.join(closure_df, "anc", "left")
            .groupBy(F.col("anc").alias("job_name")).agg(F.count("job").alias("impacted_jobs")))


def cycles(edges_df: DataFrame, rounds_per_table: int = 2) -> DataFrame:
    """Jobs that reach themselves (a registry error to report).

    Topological peeling: an edge whose parent has no parent, or whose child has no child, is in no cycle; such edges are
    taken off layer by layer from both ends until nothing changes.  A sound registry is peeled to nothing.  What is
    left lies on cycles or between two; a search upwards in this rest tells them apart.
    """
    e, n = edges_df.select("parent", "child").distinct(), -1
    while True:
        for _ in range(rounds_per_table):
            e = (e.join(e.select(F.col("child").alias("parent")).distinct(), "parent", "left_semi")
                 .join(e.select(F.col("parent").alias("child")).distinct(), "child", "left_semi").select("parent", "child"))
        e, st = _materialize(e, "peeled", F.count(F.lit(1)).alias("n"))
        if st["n"] == 0:
            return e.select(F.col("parent").alias("job_name"))
        if st["n"] == n:
            break
        n = st["n"]
    above = ancestors_of(e.select(F.col("parent").alias("job_name")), e)
    return (e.join(above, (F.col("parent") == F.col("job")) & (F.col("child") == F.col("anc")), "left_semi")
            .select(F.col("parent").alias("job_name")).distinct())
