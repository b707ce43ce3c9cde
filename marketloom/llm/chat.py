"""Chat formatting (operator 5): conversations that share initial turns as packed prefix trees.

Conversations are sorted by the digests of their turns, so those that share initial turns
are neighbours. Runs of neighbours are packed up to a size: a pack is one text that holds
every node (turn) of their prefix tree once, depth first. A node has its range in the text,
the position id of its first token in its own conversation (tokens are code points here)
and the ranges of its ancestors, which it may attend to beside itself. A tree that is
larger than a pack goes on in the next one, where the shared turns are emitted once more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A pack takes no further conversation from so many code points, or conversations, on.
PACK_CHARS, PACK_CONVERSATIONS = 1 << 16, 1024
OPEN, SHUT, END = "<turn:", ">", "</turn>\n"
LEARNED_ROLE = "assistant"

NODE = "struct<start:bigint,end:bigint,text_start:bigint,text_end:bigint,position:bigint,depth:int,parent:int,loss:boolean,attends:array<struct<start:bigint,end:bigint>>>"
SCHEMA = f"text string, nodes array<{NODE}>, conversations array<struct<conv_id:bigint,leaf:int>>"


def escape(text: str) -> str:
    """Backslashes in front of every backslash and angle bracket, so that no text holds a marker."""
    return re.sub(r"[\\<>]", r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its escaped text starts and ends."""
    head, body = f"{OPEN}{escape(role)}{SHUT}", escape(text)
    return head + body + END, len(head), len(head) + len(body)


@dataclass
class Pack:
    parts: list[str] = field(default_factory=list)
    nodes: list[dict] = field(default_factory=list)
    conversations: list[dict] = field(default_factory=list)
    path: list[int] = field(default_factory=list)  # nodes of the conversation before
    keys: list[tuple[str, str]] = field(default_factory=list)  # and their turns
    size: int = 0

    def add(self, conv_id: int | None, turns: list[tuple[str, str]]) -> None:
        shared = 0
        while shared < min(len(turns), len(self.keys)) and turns[shared] == self.keys[shared]:
            shared += 1
        self.path, self.keys = self.path[:shared], self.keys[:shared]
        for role, text in turns[shared:]:
            piece, a, b = render(role, text)
            above = self.nodes[self.path[-1]] if self.path else None
            self.nodes.append(
                {
                    "start": self.size, "end": self.size + len(piece), "text_start": self.size + a, "text_end": self.size + b,
                    "position": above["position"] + above["end"] - above["start"] if above else 0, "depth": len(self.path),
                    "parent": self.path[-1] if self.path else -1, "loss": role == LEARNED_ROLE, "attends": _attended(above),
                }
            )
            self.path.append(len(self.nodes) - 1)
            self.keys.append((role, text))
            self.parts.append(piece)
            self.size += len(piece)
        self.conversations.append({"conv_id": conv_id, "leaf": self.path[-1] if self.path else -1})

    def row(self) -> dict:
        return {"text": "".join(self.parts), "nodes": self.nodes, "conversations": self.conversations}


def _attended(parent: dict | None) -> list[dict]:
    """What a node under ``parent`` attends to: what the parent does, and the parent; touching ranges become one."""
    if parent is None:
        return []
    out, start = list(parent["attends"]), parent["start"]
    if out and out[-1]["end"] == start:
        start = out.pop()["start"]
    return [*out, {"start": start, "end": parent["end"]}]


def format_conversations(turns: DataFrame, pack_chars: int = PACK_CHARS) -> DataFrame:
    """Packs (text, nodes, conversations) of the rows (conv_id, turn, role, text).

    Turns are sorted by turn, then role and text; a null turn comes first, null roles and
    texts are empty, repeated rows are turns of their own. A row with a null conv_id is a
    conversation by itself. Turns learned from are those whose role is ``assistant``. A conversation
    larger than a pack has a pack of its own; other columns are not used.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    digest = F.md5(F.concat(F.md5("role"), F.md5("text")))
    rows = rows.withColumn("digest", F.unhex(digest))
    turn = F.struct("turn", "role", "text", "digest")
    conversations = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    conversations = conversations.union(rows.where("conv_id IS NULL").select("conv_id", F.array(turn)))
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    conversations = conversations.withColumn("path", path)
    # The id as a second key lets one conversation that many rows repeat lie in several ranges.
    laid = conversations.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    laid = laid.select("conv_id", F.transform("turns", lambda t: t["role"]).alias("roles"), F.transform("turns", lambda t: t["text"]).alias("texts"))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = Pack()
        for batch in batches:
            for conv_id, roles, texts in zip(batch["conv_id"], batch["roles"], batch["texts"], strict=True):
                if pack.conversations and (pack.size >= pack_chars or len(pack.conversations) >= PACK_CONVERSATIONS):
                    yield pd.DataFrame([pack.row()])
                    pack = Pack()
                pack.add(None if pd.isna(conv_id) else int(conv_id), list(zip(roles, texts, strict=True)))
        if pack.conversations:
            yield pd.DataFrame([pack.row()])

    return laid.mapInPandas(packed, SCHEMA)


def read_turn(piece: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    m = re.fullmatch(rf"{OPEN}((?:[^\\<>]|\\.)*){SHUT}((?:[^\\<>]|\\.)*){END}", piece, re.S)
    return unescape(m[1]), unescape(m[2])


def read_packs(packs: DataFrame) -> DataFrame:
    """Conversations read back from packs: conv_id, turns array<struct<role, text>>, learned array<string>, formatted_chars."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, nodes, conversations in zip(batch["text"], batch["nodes"], batch["conversations"], strict=True):
                turns = [read_turn(text[n["start"] : n["end"]]) for n in nodes]
                learned = [unescape(text[n["text_start"] : n["text_end"]]) if n["loss"] else None for n in nodes]
                rows = []
                for c in conversations:
                    path, at = [], int(c["leaf"])
                    while at >= 0:
                        path.append(at)
                        at = int(nodes[at]["parent"])
                    path.reverse()
                    rows.append(
                        {
                            "conv_id": c["conv_id"], "turns": [{"role": turns[i][0], "text": turns[i][1]} for i in path],
                            "learned": [learned[i] for i in path if learned[i] is not None],
                            "formatted_chars": sum(int(nodes[i]["end"] - nodes[i]["start"]) for i in path),
                        }
                    )
                    if len(rows) == 64:
                        yield pd.DataFrame(rows)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows)

    return packs.mapInPandas(
        read, "conv_id bigint, turns array<struct<role:string,text:string>>, learned array<string>, formatted_chars bigint"
    )
