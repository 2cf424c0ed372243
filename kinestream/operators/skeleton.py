"""Forward kinematics over trees that are data, and skeletons on the ordinals of a capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.functions import vec
from kinestream.functions.vec import let
from kinestream.operators.contract import enforce
from kinestream.operators.temporal import joined

_CHANNELS = [f"{a}{k}" for a in "XYZ" for k in ("rotation", "position")]


def tree_failures(nodes: DataFrame, skeleton: str = "skeleton") -> DataFrame:
    """skeleton, node and rule of each node that makes no tree: nodes count from 0 without holes, the root alone has parent -1, others a parent before them,
    offsets are three numbers and channels known ones."""
    n = nodes.groupBy(skeleton).agg(F.count("*").alias("_n"), F.countDistinct("node").alias("_d"), F.max("node").alias("_last"), F.min("node").alias("_first"))
    rules = {
        "nodes don't count from 0": ~((F.col("_n") == F.col("_d")) & (F.col("_first") == 0) & (F.col("_last") + 1 == F.col("_n"))),
        "parent isn't before its node": ~F.when(F.col("node") == 0, F.col("parent") == -1).otherwise((F.col("parent") >= 0) & (F.col("parent") < F.col("node"))),
        "offset isn't three numbers": ~((F.size("offset") == 3) & F.forall("offset", lambda x: x.isNotNull() & ~F.isnan(x))),
        "unknown channel": ~F.forall("channels", lambda c: F.lower(c).isin([x.lower() for x in _CHANNELS])),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(True)), F.lit(rule)) for rule, broken in rules.items()]))
    return joined(nodes, n, [skeleton]).select(skeleton, "node", F.explode(found).alias("rule"))


def trees(nodes: DataFrame, skeleton: str = "skeleton") -> DataFrame:
    """A row for each skeleton: its nodes in order (parent, offset, channels with the place of each one's value) and the number of values of a frame.

    nodes: skeleton, node, parent, offset (array of three), channels (names as Xrotation or Yposition). Anything but trees is a ContractError.
    """
    enforce(tree_failures(nodes, skeleton), "no tree of nodes")
    listed = F.array_sort(F.collect_list(F.struct("node", "parent", "offset", "channels")))
    axis = lambda c: F.instr(F.lit("XYZ"), F.upper(F.substring(c, 1, 1))) - 1

    def placed(all_nodes: Column) -> Column:
        def one(n: Column, i: Column) -> Column:
            before = F.aggregate(F.slice(all_nodes, F.lit(1), i), F.lit(0), lambda s, m: s + F.size(m["channels"]))
            channels = F.transform(n["channels"], lambda c, k: F.struct(axis(c).alias("axis"), F.endswith(F.lower(c), F.lit("position")).alias("moves"), (before + k).alias("at")))
            return F.struct(n["parent"].alias("parent"), vec.vec(*[F.get(n["offset"], F.lit(k)) for k in range(3)]).alias("offset"), channels.alias("channels"))

        return F.transform(all_nodes, one)

    rows = nodes.groupBy(skeleton).agg(listed.alias("_nodes"))
    return rows.select(skeleton, placed(F.col("_nodes")).alias("tree"), F.aggregate("_nodes", F.lit(0), lambda s, n: s + F.size(n["channels"])).alias("width"))


def _axis(k: Column, x: Column) -> list[Column]:
    return [F.when(k == i, x).otherwise(0.0) for i in range(3)]


def places(tree: Column, values: Column) -> Column:
    """World positions of all nodes of one frame as an array, node by node: a node stands where its parent's axes put its offset and moves.

    Channels apply in their order; positions move, rotations (degrees) turn. One fold over the nodes, inside the row: no join and no shuffle for each level.
    """

    def local(node: Column, given: Column) -> Column:
        def channel(s: Column, c: Column) -> Column:
            v = F.get(given, c["at"])
            half = F.radians(v) / 2
            turn = vec.quat(F.cos(half), *_axis(c["axis"], F.sin(half)))
            moved = F.struct(vec.add(s["shift"], vec.vec(*_axis(c["axis"], v))).alias("shift"), s["turn"].alias("turn"))
            turned = F.struct(s["shift"].alias("shift"), vec.quat_product(s["turn"], turn).alias("turn"))
            return F.when(c["moves"], moved).otherwise(turned)

        start = F.struct(node["offset"].alias("shift"), vec.quat(*[F.lit(float(i == 0)) for i in range(4)]).alias("turn"))
        return F.aggregate(node["channels"], start, channel)

    def folded(given: Column) -> Column:
        def step(s: Column, node: Column) -> Column:
            own = F.struct(local(node, given["values"]).alias("own"), F.get(s["places"], node["parent"]).alias("place"), F.get(s["turns"], node["parent"]).alias("axes"))
            made = let(
                own,
                lambda q: F.struct(
                    F.when(q["place"].isNull(), q["own"]["shift"]).otherwise(vec.add(q["place"], vec.quat_rotate(q["axes"], q["own"]["shift"]))).alias("place"),
                    F.when(q["axes"].isNull(), q["own"]["turn"]).otherwise(vec.quat_product(q["axes"], q["own"]["turn"])).alias("axes"),
                ),
            )
            return let(made, lambda m: F.struct(F.concat(s["places"], F.array(m["place"])).alias("places"), F.concat(s["turns"], F.array(m["axes"])).alias("turns")))

        nothing = F.struct(F.slice(F.array(vec.vec(*[F.lit(0.0)] * 3)), 1, 0).alias("places"), F.slice(F.array(vec.quat(*[F.lit(0.0)] * 4)), 1, 0).alias("turns"))
        return F.aggregate(given["tree"], nothing, step, lambda s: s["places"])

    return let(F.struct(tree.alias("tree"), values.alias("values")), folded)


def world_positions(nodes: DataFrame, motion: DataFrame, skeleton: str = "skeleton") -> DataFrame:
    """skeleton, frame and points (an array of structs x, y, z by node) of each frame of ``motion`` (skeleton, frame, values).

    A frame with another number of values than its tree's channels, or a value that is missing, has null points; one of an unknown skeleton, too.
    """
    rows = joined(motion, trees(nodes, skeleton), [skeleton])
    good = (F.size("values") == F.col("width")) & F.forall("values", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.select(skeleton, "frame", F.when(good, places(F.col("tree"), F.col("values"))).alias("points"))


def capture_contract(points: DataFrame, capture: DataFrame, tolerance: float, skeleton: str = "skeleton") -> DataFrame:
    """Per skeleton: frames, rows, root_error (the largest difference of a root's coordinate from frame 1 on) and passed.

    A skeleton's frames are the capture's rows and one more at the end, that has no time; frame i is row i. capture: skeleton, ordinal, root (struct x, y, z).
    """
    root = points.select(skeleton, F.col("frame").alias("ordinal"), F.get("points", F.lit(0)).alias("at"))
    both = root.join(capture.select(skeleton, "ordinal", "root"), [skeleton, "ordinal"])
    off = F.greatest(*[F.abs(F.col(f"at.{a}") - F.col(f"root.{a}")) for a in "xyz"])
    error = both.where("ordinal >= 1").groupBy(skeleton).agg(F.max(off).alias("root_error"), F.count_if(off.isNull()).alias("_unknown"))
    span = lambda df, i, n: df.groupBy(skeleton).agg(F.count("*").alias(n), F.countDistinct(i).alias(f"_{n}"), F.min(i).alias(f"_{n}0"), F.max(i).alias(f"_{n}1"))
    found = joined(joined(span(points, "frame", "frames"), span(capture, "ordinal", "rows"), [skeleton]), error, [skeleton])
    dense = [(F.col(n) == F.col(f"_{n}")) & (F.col(f"_{n}0") == 0) & (F.col(f"_{n}1") + 1 == F.col(n)) for n in ("frames", "rows")]
    passed = dense[0] & dense[1] & (F.col("frames") == F.col("rows") + 1) & (F.col("_unknown") == 0) & (F.col("root_error") <= tolerance)
    return found.select(skeleton, "frames", "rows", "root_error", F.coalesce(passed, F.lit(False)).alias("passed"))


def on_capture(points: DataFrame, capture: DataFrame, tolerance: float, skeleton: str = "skeleton") -> DataFrame:
    """The capture's rows, all of their columns, with the skeleton's points of the same ordinal; null in row 0, whose frame is a seed without a pose.

    A skeleton that breaks ``capture_contract`` is a ContractError: nothing is shifted or cut to fit.
    """
    enforce(capture_contract(points, capture, tolerance, skeleton).where("not passed"), "skeletons that aren't their capture's")
    own = points.where("frame >= 1").select(skeleton, F.col("frame").alias("ordinal"), "points")
    return joined(capture, own, [skeleton, "ordinal"])
