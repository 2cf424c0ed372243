"""BVH motion text: joint tree, motion rows, and world positions by forward kinematics."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

NODES = "path string, node int, name string, parent int, offset array<double>, channels array<string>"
POSITIONS = "path string, frame long, node int, name string, x double, y double, z double"


def parse(text: str) -> tuple[list[dict], float, np.ndarray]:
    """Nodes in the order of the text (end sites have no channels), seconds of a frame, and motion rows (frames x channels).

    Raises ValueError for anything but a tree of joints and as many whole rows as the header says.
    """
    head, found, tail = text.partition("MOTION")
    if not found:
        raise ValueError("no MOTION section")
    tokens, nodes, stack, at = head.split(), [], [], 1
    if not tokens or tokens[0] != "HIERARCHY":
        raise ValueError("no HIERARCHY section")
    while at < len(tokens):
        word = tokens[at]
        if word in ("ROOT", "JOINT", "End"):
            name = tokens[at + 1] if word != "End" else f"{nodes[stack[-1]]['name']}_end"
            nodes.append({"name": name, "parent": stack[-1] if stack else -1, "offset": None, "channels": []})
            at += 2
        elif word == "{":
            stack.append(len(nodes) - 1)
            at += 1
        elif word == "}":
            if not stack:
                raise ValueError("unbalanced braces")
            stack.pop()
            at += 1
        elif word == "OFFSET":
            nodes[stack[-1]]["offset"] = [float(x) for x in tokens[at + 1 : at + 4]]
            at += 4
        elif word == "CHANNELS":
            n = int(tokens[at + 1])
            nodes[stack[-1]]["channels"] = tokens[at + 2 : at + 2 + n]
            at += 2 + n
        else:
            raise ValueError(f"unexpected {word!r} in the hierarchy")
    if stack or not nodes or any(n["offset"] is None or len(n["offset"]) != 3 for n in nodes):
        raise ValueError("the hierarchy is not complete")
    stated = re.match(r"\s*Frames:\s*(\d+)\s+Frame\s+Time:\s*(\S+)\s*\n?", tail)
    if not stated:
        raise ValueError("no frame count and time")
    rows = [line.split() for line in tail[stated.end() :].splitlines() if line.strip()]
    width = sum(len(n["channels"]) for n in nodes)
    if len(rows) != int(stated[1]) or any(len(r) != width for r in rows):
        raise ValueError("motion rows don't fit the header")
    return nodes, float(stated[2]), np.array(rows, dtype=float).reshape(len(rows), width)


def world_positions(nodes: list[dict], motion: np.ndarray) -> np.ndarray:
    """frames x nodes x 3. Channels apply in their declared order; positions move, rotations (degrees) turn."""
    n = len(motion)
    places, turns, at = np.zeros((n, len(nodes), 3)), [None] * len(nodes), 0
    for j, node in enumerate(nodes):
        shift, turn = np.tile(node["offset"], (n, 1)).astype(float), np.tile(np.eye(3), (n, 1, 1))
        for channel in node["channels"]:
            axis, value = "XYZ".index(channel[0].upper()), motion[:, at]
            at += 1
            if channel.lower().endswith("position"):
                shift[:, axis] += value
                continue
            c, s = np.cos(np.radians(value)), np.sin(np.radians(value))
            one = np.zeros((n, 3, 3))
            a, b = [(1, 2), (2, 0), (0, 1)][axis]
            one[:, axis, axis], one[:, a, a], one[:, b, b], one[:, a, b], one[:, b, a] = 1, c, c, -s, s
            turn = turn @ one
        p = node["parent"]
        if p < 0:
            places[:, j], turns[j] = shift, turn
        else:
            places[:, j] = places[:, p] + np.einsum("nij,nj->ni", turns[p], shift)
            turns[j] = turns[p] @ turn
    return places


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """One row for each node of each file."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(p, i, n["name"], n["parent"], n["offset"], n["channels"]) for p, raw in zip(f["path"], f["content"], strict=True) for i, n in enumerate(parse(bytes(raw).decode())[0])]
            yield pd.DataFrame(rows, columns=["path", "node", "name", "parent", "offset", "channels"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, NODES)


def read_positions(spark: SparkSession, path: str, chunk: int = 2000) -> DataFrame:
    """World positions, one row for each frame and node; a file is one task, its rows leave it in chunks of frames."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p, raw in zip(f["path"], f["content"], strict=True):
                nodes, _, motion = parse(bytes(raw).decode())
                for first in range(0, len(motion), chunk):
                    xyz = world_positions(nodes, motion[first : first + chunk])
                    k, m = xyz.shape[:2]
                    flat = xyz.reshape(-1, 3)
                    yield pd.DataFrame({"path": p, "frame": np.repeat(np.arange(first, first + k), m), "node": np.tile(np.arange(m, dtype="int32"), k), "name": np.tile([n["name"] for n in nodes], k), "x": flat[:, 0], "y": flat[:, 1], "z": flat[:, 2]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, POSITIONS)
