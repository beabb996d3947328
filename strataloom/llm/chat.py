"""Chat formatting at token level.

Role and text of each turn are encoded as segments of their own, and reserved ids are spliced
around them, so no text can produce a reserved id. The loss mask is the running sum of +1 and -1
marks at segment borders. The formatted text is the same sequence with the marks written out;
control strings that occur inside roles and texts get one backslash after their first character
(one more, where some stand there already), which reading back takes out again.

Defined results: a null role or text is empty; turns come by number, a null number first, and
equal numbers by a digest of their formatted text; repeated rows are turns each; a null conversation id is a
conversation of its own; an empty table gives an empty table; columns other than the four named
are not read. Turns of one conversation may lie in many partitions: places are running sums within
partitions plus the sums of the partitions before.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

# The marks of the template, and control strings of common chat templates.
BEGIN, HEAD, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = (BEGIN, HEAD, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

TOGETHER = 200  # turns that are encoded or decoded in one go

_TAILS = {c: "|".join(re.escape(x[1:]) for x in CONTROLS if x[0] == c) for c in "<["}
_PLAIN = re.compile("|".join(rf"{re.escape(c)}(?=\\*(?:{tails}))" for c, tails in _TAILS.items()))
_MARKED = re.compile("|".join(rf"(?<={re.escape(c)})\\(?=\\*(?:{tails}))" for c, tails in _TAILS.items()))


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return _MARKED.sub("", text)


def _encoder(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_str(vocabulary)
    encoder.encode_special_tokens = True
    return encoder


def _vocabulary(spark, tokenizer: str):
    """The tokenizer file, of fixed size, for all executors; `tokenizer` is a path on the driver."""
    with open(tokenizer, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def format_turns(conversations: DataFrame, tokenizer: str, trained_role: str = "assistant") -> DataFrame:
    """One row per turn: conv_id, turn, `ids`, `loss_mask`, `formatted`.

    Reserved ids follow the vocabulary: begin, head, end. The mask covers the text of turns of
    `trained_role` and the end id after it.
    """
    vocabulary = _vocabulary(conversations.sparkSession, tokenizer)

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(vocabulary.value)
        reserved = encoder.get_vocab_size(with_added_tokens=True)
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                some = batch.iloc[at:at + TOGETHER]
                roles, texts = [escape(x) for x in some["role"]], [escape(x) for x in some["text"]]
                heads = encoder.encode_batch_fast(roles, add_special_tokens=False)
                bodies = encoder.encode_batch_fast(texts, add_special_tokens=False)
                ids, masks = [], []
                for role, head, body in zip(some["role"], heads, bodies):
                    head, body = head.ids, body.ids
                    ids.append(np.array([reserved, *head, reserved + 1, *body, reserved + 2], np.int32))
                    step = np.zeros(len(ids[-1]) + 1, np.int8)
                    if role == trained_role:
                        step[len(head) + 2] += 1
                        step[-1] -= 1
                    masks.append(np.cumsum(step[:-1], dtype=np.int8))
                yield pd.DataFrame({
                    "conv_id": some["conv_id"], "turn": some["turn"], "ids": ids, "loss_mask": masks,
                    "formatted": [BEGIN + r + HEAD + t + END for r, t in zip(roles, texts)]})

    turns = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return turns.mapInPandas(
        assemble, f"conv_id {kind}, turn long, ids array<int>, loss_mask array<tinyint>, formatted string")


def format_conversations(conversations: DataFrame, tokenizer: str, trained_role: str = "assistant") -> DataFrame:
    """`format_turns` with `position`, the number of ids of the conversation before the turn.

    The turns of a conversation, by position, are its token sequence and mask.
    """
    turns = materialize(format_turns(conversations, tokenizer, trained_role).withColumns({
        "__n": F.size("ids").cast("long"), "__tie": F.sha2("formatted", 256), "__row": F.monotonically_increasing_id()}))
    order = [F.col("conv_id"), F.col("turn"), F.col("__tie")]
    ordered = materialize(
        turns.select(*order, "__n", "__row").repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    within = W.partitionBy("__part", "conv_id").orderBy("turn", "__tie", "__row").rowsBetween(W.unboundedPreceding, -1)
    sums = ordered.groupBy("conv_id", "__part").agg(F.sum("__n").alias("__sum"))
    before = W.partitionBy("conv_id").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(F.col("conv_id").alias("__conv"), F.col("__part").alias("__p"),
                         F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    placed = ordered.withColumn("__inner", F.coalesce(F.sum("__n").over(within), F.lit(0)))
    placed = placed.join(starts, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("__part") == F.col("__p")))
    position = placed.select("__row", (F.col("__before") + F.col("__inner")).alias("position"))
    return turns.join(position, "__row").select("conv_id", "turn", "position", "ids", "loss_mask", "formatted")


def read_back(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """Per conversation, what its tokens and mask say: number of turns, digests of turns and of the trained text.

    A digest runs over the turns of a conversation in order, so one task reads a conversation; it
    holds one batch of it at a time.
    """
    vocabulary = _vocabulary(formatted.sparkSession, tokenizer)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(vocabulary.value)
        reserved = encoder.get_vocab_size(with_added_tokens=True)
        marks = len(BEGIN) + len(HEAD) + len(END)
        now, state, done = None, None, []
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                some = batch.iloc[at:at + TOGETHER]
                parts = []
                for ids, mask in zip(some["ids"], some["loss_mask"]):
                    ids, mask = np.asarray(ids), np.asarray(mask)
                    places = np.flatnonzero(ids >= reserved)
                    if (ids[places] - reserved).tolist() != [0, 1, 2] or places[0] or places[2] != len(ids) - 1:
                        raise ValueError("a turn without its marks")
                    head = places[1]
                    parts += [ids[1:head], ids[head + 1:-1], ids[(mask == 1) & (ids < reserved)]]
                texts = encoder.decode_batch([p.tolist() for p in parts], skip_special_tokens=False)
                for i, (conv, missing) in enumerate(zip(some["__conv"], some["__missing"])):
                    if (conv, missing) != now:
                        if state:
                            done.append(_closed(now, state))
                        now, state = (conv, missing), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    role, text, trained = texts[3 * i:3 * i + 3]
                    state[4] += marks + len(role) + len(text)
                    state[0] += 1
                    state[1].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                    trained = unescape(trained)
                    state[2] += len(trained)
                    state[3].update(trained.encode())
            yield pd.DataFrame(done, columns=names).astype({"conv_id": object})
            done = []
        if state:
            yield pd.DataFrame([_closed(now, state)], columns=names).astype({"conv_id": object})

    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [x.split()[0] for x in schema.split(", ")]
    blank = F.lit("") if kind == "string" else F.lit(0).cast(kind)
    rows = formatted.select(
        F.coalesce("conv_id", blank).alias("__conv"), F.col("conv_id").isNull().alias("__missing"), "position", "ids", "loss_mask")
    ordered = rows.repartition("__conv", "__missing").sortWithinPartitions("__missing", "__conv", "position")
    return ordered.mapInPandas(digest, schema)


def _closed(key, state):
    conv, missing = key
    turns, all_turns, chars, trained, formatted = state
    return (None if missing else conv, turns, all_turns.hexdigest(), chars, trained.hexdigest(), formatted)
