"""Gene trees: Newick text, rooting, clades, sister taxa, branch lengths, choice of orthologs.

A tree table has a row for each node: tree_id, node_id, parent_id (null at the root), name, dist, is_leaf, postorder.
Parsing and rooting work on one tree at a time; the rest are joins and aggregates over all trees together.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.staging import staged
from . import intervals

NODE_TABLE = "tree_id string, node_id long, parent_id long, name string, dist double, is_leaf boolean, postorder long"
#: Groups that a tree is rooted by, first match first.
ROOT_GROUPS = ("Prok", "Opisthokonta", "Archaeplastida", "Amoebozoa", "Discoba", "Metamonada", "SAR", "Orphan")


class Node:
    __slots__ = ("name", "dist", "children", "parent")

    def __init__(self, name: str = "", dist: float = 0.0):
        self.name, self.dist, self.children, self.parent = name, dist, [], None

    def add(self, child: Node) -> None:
        child.parent = self
        self.children.append(child)

    def walk(self) -> list[Node]:
        """All nodes below and this one, children first."""
        out, work = [], [self]
        while work:
            node = work.pop()
            out.append(node)
            work += node.children
        return out[::-1]

    def leaves(self) -> list[Node]:
        return [n for n in self.walk() if not n.children]


def parse_newick(text: str) -> Node:
    """The root of a tree; names may be quoted, comments in brackets are left out."""
    text = re.sub(r"\[[^\]]*\]", "", text).strip()
    if not text.endswith(";"):
        raise ValueError("a Newick tree ends with a semicolon")
    here = root = Node()
    fresh = True
    for token in re.findall(r"'(?:[^']|'')*'|[(),:;]|[^(),:;'\s][^(),:;]*", text):
        if token == "(":
            child = Node()
            here.add(child)
            here = child
        elif token == ",":
            child = Node()
            here.parent.add(child)
            here = child
        elif token == ")":
            here = here.parent
        elif token == ":":
            fresh = False
            continue
        elif token == ";":
            break
        elif not fresh:
            here.dist = float(token)
        else:
            here.name = token[1:-1].replace("''", "'") if token[0] == "'" else token.strip()
        fresh = True
    return root


def resolve(root: Node) -> Node:
    """Makes every inner node binary: further children hang on new nodes of length zero."""
    for node in root.walk():
        while len(node.children) > 2:
            a, b = node.children[-2:]
            node.children = node.children[:-2]
            joint = Node()
            joint.add(a)
            joint.add(b)
            node.add(joint)
    return root


def to_newick(root: Node) -> str:
    text: dict[Node, str] = {}
    for n in root.walk():
        name = f"'{n.name.replace(chr(39), chr(39) * 2)}'" if re.search(r"[(),:;'\s]", n.name) else n.name
        inner = f"({','.join(text.pop(c) for c in n.children)})" if n.children else ""
        text[n] = f"{inner}{name}" + (f":{n.dist:.6g}" if n.parent is not None else "")
    return text[root] + ";"


def reroot(root: Node, at: Node, above: float | None = None) -> Node:
    """A new root on the branch over a node, `above` from it (half of the branch if not given); inner nodes left with one child go."""
    if at.parent is None or (at.parent is root and len(root.children) == 2 and above is None):
        return root
    length = at.dist
    new, up = Node(), at.parent
    up.children.remove(at)
    new.add(at)
    at.dist = length / 2 if above is None else above
    child, rest = new, length - at.dist
    while up is not None:
        nxt, old = up.parent, up.dist
        if nxt is not None:
            nxt.children.remove(up)
        child.add(up)
        up.dist, rest = rest, old
        child, up = up, nxt
    if len(root.children) == 1 and root.parent is not None:  # the old root has become a link
        only, over = root.children[0], root.parent
        only.dist += root.dist
        over.children[over.children.index(root)] = only
        only.parent = over
    new.parent = None
    return new


def midpoint(root: Node) -> Node:
    """The tree rooted half way between its two farthest leaves."""

    def farthest(start: Node) -> tuple[Node, float, dict]:
        seen, work, best = {start: (None, 0.0)}, [start], (start, 0.0)
        while work:
            n = work.pop()
            near = [(c, c.dist) for c in n.children] + ([(n.parent, n.dist)] if n.parent is not None else [])
            for m, d in near:
                if m not in seen:
                    seen[m] = (n, seen[n][1] + d)
                    work.append(m)
                    if not m.children and seen[m][1] > best[1] + 1e-12:
                        best = (m, seen[m][1])
        return (*best, seen)

    leaves = root.leaves()
    if len(leaves) < 3:
        return root
    a, _, _ = farthest(leaves[0])
    b, length, seen = farthest(a)
    at, half = b, length / 2
    while seen[at][0] is not None and seen[seen[at][0]][1] > half:
        at = seen[at][0]
    over = seen[at][0]
    if over is None:
        return root
    if at.parent is over:
        return reroot(root, at, seen[at][1] - half)
    return reroot(root, over, half - seen[over][1])


def root_by_group(root: Node, group_of: dict[str, str], domain_of: dict[str, str]) -> Node:
    """Midpoint first; then by the first group of ROOT_GROUPS with a clade of its own of more than one leaf: that of most taxa, first in post-order."""
    root = midpoint(root)
    for group in ROOT_GROUPS:
        inside = (lambda t: domain_of.get(t) in ("Bacteria", "Archaea")) if group == "Prok" else (lambda t, g=group: group_of.get(t) == g)
        best, most = None, 0
        for node in root.walk():
            if node is root or not node.children:
                continue
            taxa = [leaf.name.split("|")[0] for leaf in node.leaves()]
            if len(taxa) > 1 and all(map(inside, taxa)) and len(set(taxa)) > most:
                best, most = node, len(set(taxa))
        if best is not None:
            return reroot(root, best)
    return root


def node_rows(tree_id: str, root: Node) -> list[tuple]:
    order = root.walk()
    number = {n: k for k, n in enumerate(order)}
    return [(tree_id, k, None if n.parent is None else number[n.parent], n.name, float(n.dist), not n.children, k) for k, n in enumerate(order)]


def from_newick(trees: DataFrame, taxa: DataFrame | None = None) -> DataFrame:
    """The node table of trees (tree_id, newick), polytomies resolved; with taxa (taxon, domain, supergroup) rooted by them.

    Trees of fewer than two groups go if taxa are given. taxa is a dimension: a row for each taxon of the leaves.
    """
    known = [] if taxa is None else taxa.select("taxon", "domain", "supergroup").collect()
    groups, domains = {r[0]: r[2] for r in known}, {r[0]: r[1] for r in known}
    ask = taxa is not None
    columns = [c.split()[0] for c in NODE_TABLE.split(", ")]

    def run(frames):
        for pdf in frames:
            out = []
            for tree_id, text in zip(pdf["tree_id"], pdf["newick"], strict=True):
                root = resolve(parse_newick(text))
                if ask:
                    if len({groups.get(leaf.name.split("|")[0]) for leaf in root.leaves()}) < 2:
                        continue
                    root = root_by_group(root, groups, domains)
                out += node_rows(tree_id, root)
            frame = pd.DataFrame(out, columns=columns)
            frame["parent_id"] = frame["parent_id"].astype("Int64")
            yield frame

    return trees.select("tree_id", "newick").mapInPandas(run, NODE_TABLE)


def as_newick(nodes: DataFrame) -> DataFrame:
    """tree_id and Newick text of each tree of a node table."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        made = {r.node_id: Node(r.name_, r.dist) for r in pdf.rename(columns={"name": "name_"}).itertuples()}
        root = None
        for r in pdf.sort_values("postorder").itertuples():
            if pd.isna(r.parent_id):
                root = made[r.node_id]
            else:
                made[int(r.parent_id)].add(made[r.node_id])
        return pd.DataFrame({"tree_id": [pdf["tree_id"].iloc[0]], "newick": [to_newick(root)]})

    return nodes.groupBy("tree_id").applyInPandas(one, "tree_id string, newick string")


class Forest:
    """A node table (tree_id, node_id, parent_id, dist, is_leaf, ...) with its steps upwards and, when asked for, its intervals."""

    def __init__(self, nodes: DataFrame):
        self.nodes = nodes
        self.ways = intervals.steps(nodes)
        self._spans: DataFrame | None = None

    @property
    def spans(self) -> DataFrame:
        if self._spans is None:
            self._spans = intervals.intervals(self.nodes, self.ways)
        return self._spans

    def root_distances(self) -> DataFrame:
        return intervals.root_distances(self.nodes, self.ways)


def clade_sizes(forest: Forest, nodes: DataFrame, group: str = "supergroup") -> DataFrame:
    """tree_id, node_id, group, leaves and taxa of every inner node whose leaves (with a taxon and a group) are of one group.

    Counts and groups are rolled up. The taxa below a node are its leaves with a taxon less the nodes below it, and itself,
    at which two leaves of one taxon that follow each other in the tree meet: so each taxon counts once.
    """
    key = intervals.KEY
    leaves = nodes.where("is_leaf").select(*key, "taxon", group)
    named = staged(leaves.where("taxon is not null").join(forest.spans, key), "named-leaves")
    pairs = intervals.previous(named, ["tree_id", "taxon"]).withColumnRenamed("node_id", "_later").withColumnRenamed("before", "node_id").withColumnRenamed("first", "_first")
    spans = forest.spans.select("tree_id", "node_id", F.col("last").alias("_last"))
    met = intervals.climbed(pairs.select("tree_id", "node_id", "_first"), forest.ways, spans, F.col("_last") < F.col("_first"))
    again = met.select("tree_id", F.col("stop_id").alias("node_id"), F.lit(-1).cast("long").alias("taxa"))
    taxa = named.select(*key, F.lit(1).cast("long").alias("taxa")).unionByName(again).groupBy(*key).agg(F.sum("taxa").alias("taxa"))
    own = leaves.select(*key, F.lit(1).cast("long").alias("leaves"), F.col(group).alias("_lo"), F.col(group).alias("_hi"))
    values = own.join(taxa, key, "full").select(*key, F.coalesce("leaves", F.lit(0)).alias("leaves"), "_lo", "_hi", F.coalesce("taxa", F.lit(0)).alias("taxa"))
    found = intervals.rolled(values, forest.ways, {"leaves": "sum", "_lo": "min", "_hi": "max", "taxa": "sum"})
    inner = forest.ways[0].select("tree_id", F.col("up").alias("node_id")).distinct()
    return found.where("_lo = _hi").join(inner, key, "left_semi").select(*key, F.col("_lo").alias(group), "leaves", "taxa")


def stops(leaves: DataFrame, forest: Forest) -> DataFrame:
    """leaves (tree_id, node_id, prefix, ...) with stop_id, the first ancestor with more than one prefix below it; leaves of trees of one prefix go."""
    values = leaves.where("prefix is not null").select(*intervals.KEY, F.col("prefix").alias("_lo"), F.col("prefix").alias("_hi"))
    ends = intervals.rolled(values, forest.ways, {"_lo": "min", "_hi": "max"})
    every = forest.nodes.select(*intervals.KEY).join(ends, intervals.KEY, "left")
    return intervals.climbed(leaves, forest.ways, every, F.col("_lo").isNull() | (F.col("_lo") == F.col("_hi")))


class Sisters:
    """For each leaf the leaves of other taxa under its stop. All leaves of a taxon with one stop have the same ones, so
    what is kept is a row for each stop and taxon; nothing is listed leaf by leaf unless rows() is asked for.

    leaves: tree_id, node_id, prefix, taxon and more columns, which sisters have as well. A leaf whose whole tree has one
    prefix, or whose sisters all lack a taxon, has none.
    """

    def __init__(self, leaves: DataFrame, forest: Forest):
        self.stops = staged(stops(leaves, forest).select("tree_id", F.col("node_id").alias("leaf"), "stop_id", "taxon"), "stops")
        tops = self.stops.select("tree_id", "stop_id").distinct()
        held = leaves.where("taxon is not null").drop("prefix").join(forest.spans.select(*intervals.KEY, "first"), intervals.KEY)
        self.under = staged(intervals.below(tops, forest.spans, held).drop("first").withColumnRenamed("node_id", "sister"), "under-stops")

    def rows(self) -> DataFrame:
        """tree_id, leaf, stop_id, sister, sister_taxon and the other columns of the sister: as many rows as leaves have sisters."""
        other = self.under.withColumnRenamed("taxon", "sister_taxon")
        return self.stops.join(other, ["tree_id", "stop_id"]).where("taxon != sister_taxon").drop("taxon")

    def counts(self) -> DataFrame:
        """tree_id, leaf, stop_id, sisters and sister_taxa: how many leaves and taxa the sisters are; leaves without any go."""
        by_taxon = self.under.groupBy("tree_id", "stop_id", "taxon").agg(F.count(F.lit(1)).alias("_own"))
        whole = by_taxon.groupBy("tree_id", "stop_id").agg(F.sum("_own").alias("_all"), F.count(F.lit(1)).alias("_taxa"))
        found = by_taxon.join(whole, ["tree_id", "stop_id"]).select("tree_id", "stop_id", "taxon", (F.col("_all") - F.col("_own")).alias("sisters"), (F.col("_taxa") - 1).alias("sister_taxa"))
        return self.stops.join(found.where("sisters > 0"), ["tree_id", "stop_id", "taxon"]).drop("taxon")

    def agreed(self, levels: list[str]) -> DataFrame:
        """tree_id, leaf and for each level the label that all sisters have, else null. Levels are columns of the leaves, or taxon.

        Of a stop it is enough to know how often each label comes up, and how often among the leaves of one taxon.
        """
        key = ["tree_id", "stop_id"]
        whole = self.under.groupBy(*key).agg(F.count(F.lit(1)).alias("_all"))
        out = self.counts().select("tree_id", "leaf", "stop_id").join(self.stops, ["tree_id", "leaf", "stop_id"]).select("tree_id", "leaf", "stop_id", "taxon")
        sizes = self.under.groupBy(*key, "taxon").agg(F.count(F.lit(1)).alias("_own")).join(whole, key).select(*key, "taxon", (F.col("_all") - F.col("_own")).alias("_left"))
        out = out.join(sizes, [*key, "taxon"])
        for level in levels:
            labels = self.under.withColumn("_label", F.col(level)).where("_label is not null")
            by_label = labels.groupBy(*key, "_label").agg(F.count(F.lit(1)).alias("_n"))
            own = labels.groupBy(*key, "taxon", "_label").agg(F.count(F.lit(1)).alias("_mine"))
            # A label that all others have is the commonest or, without one's own leaves, the second: two of a stop will do.
            order = Window.partitionBy(*key).orderBy(F.desc("_n"), "_label")
            several = by_label.withColumn("_place", F.row_number().over(order)).where("_place <= 2").select(*key, "_label", "_n")
            asked = out.select(*key, "taxon", "_left").distinct().join(several, key).join(own, [*key, "taxon", "_label"], "left")
            sure = asked.where(F.col("_n") - F.coalesce("_mine", F.lit(0)) == F.col("_left")).groupBy(*key, "taxon").agg(F.min("_label").alias(f"agreed_{level}"))
            out = out.join(sure, [*key, "taxon"], "left")
        return out.select("tree_id", "leaf", *(F.col(f"agreed_{x}").alias("sister_taxon" if x == "taxon" else x) for x in levels))

    def lists(self, most: int = 20, name: str = "sister") -> DataFrame:
        """tree_id, leaf, n_sister_taxa and the sister taxa and leaves (their `name`) as text; beyond `most` taxa the texts only say so.

        Stops of more taxa than that aren't listed at all, so of a stop there are most + 1 taxa, each with the others.
        """
        key = ["tree_id", "stop_id"]
        counted = self.counts()
        small = counted.where(F.col("sister_taxa") <= most).select(*key).distinct()
        by_taxon = self.under.join(small, key, "left_semi").groupBy(*key, F.col("taxon").alias("_other")).agg(F.collect_set(name).alias("_names"))
        own = self.stops.join(small, key, "left_semi").select(*key, "taxon").distinct()
        per = own.join(by_taxon, key).where("taxon != _other").groupBy(*key, "taxon").agg(F.array_sort(F.collect_list("_other")).alias("_t"), F.array_sort(F.flatten(F.collect_list("_names"))).alias("_s"))
        texts = per.select(*key, "taxon", F.array_join("_t", ";").alias("_taxa"), F.array_join(F.transform("_s", lambda x: x.cast("string")), ";").alias("_leaves"))
        many = F.col("sister_taxa") > most
        rows = counted.join(self.stops.select("tree_id", "leaf", "taxon"), ["tree_id", "leaf"]).join(texts, [*key, "taxon"], "left")
        return rows.select(
            "tree_id", "leaf", F.col("sister_taxa").cast("int").alias("n_sister_taxa"), F.when(many, f"More-than-{most}").otherwise(F.col("_taxa")).alias("sister_taxa"),
            F.when(many, "Too-many-seqs").otherwise(F.col("_leaves")).alias("sister_leaves"),
        )


def branch_verdicts(nodes: DataFrame, mode: str = "median") -> DataFrame:
    """Leaves with the median or average length of their tree's leaves; at most that is short, beyond it long."""
    leaves = nodes.where("is_leaf")
    middle = F.percentile("dist", F.lit(0.5)) if mode == "median" else F.avg("dist")
    return leaves.join(leaves.groupBy("tree_id").agg(middle.alias("threshold")), "tree_id").withColumn("verdict", F.when(F.col("dist") <= F.col("threshold"), "short").otherwise("long"))


def pick_orthologs(candidates: DataFrame, group: list[str]) -> DataFrame:
    """The best sequence of each group: most taxonomy levels shared with the sisters, most sister taxa, least distance to the root, id.

    candidates: the group, id, same (levels shared, null as 0), n_sister_taxa, root_dist.
    """
    order = Window.partitionBy(*group).orderBy(F.desc(F.coalesce("same", F.lit(0))), F.desc("n_sister_taxa"), "root_dist", "id")
    return candidates.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")
