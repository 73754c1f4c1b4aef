"""Deterministic stand-ins for language and embedding models."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pairsmith.operators.model_map import register_embedder, register_generator

DIM = 64
FENCE = "`" * 3


def _user_text(messages: list[dict]) -> str:
    return messages[-1]["content"]


def echo_chat(options: dict):
    """Number of messages, and the digest of the user's text."""
    return lambda prompts, params: [f"{len(p)}:{hashlib.md5(_user_text(p).encode()).hexdigest()}" for p in prompts]


def echo_base(options: dict):
    """Number of characters and the temperature."""
    return lambda prompts, params: [f"{len(p)}@{q.get('temperature')}" for p, q in zip(prompts, params)]


def sentence_json(options: dict):
    """Three fields made of the prompt: its first line, its digest, and the line in capitals."""
    keys = options["keys"]

    def reply(prompt: str) -> str:
        line, digest = prompt.split("\n", 1)[0], hashlib.md5(prompt.encode()).hexdigest()
        text = json.dumps(dict(zip(keys, (line, digest, line.upper()))), ensure_ascii=False)
        if digest[0] in "0123":
            return f"Sure!\n{FENCE}json\n{text}\n{FENCE}"
        return text[:-1] + ",}" if digest[0] in "4567" else text

    return lambda prompts, params: [reply(_user_text(p)) for p in prompts]


def passage_json(options: dict):
    """A query of the first three words of the prompt's passage, and the passage as its document."""

    def reply(prompt: str) -> str:
        passage = prompt.split("\nPassage: ", 1)[1]
        query = " ".join(passage.split(" ")[:3])
        return json.dumps({"user_query": query, "positive_document": passage}, ensure_ascii=False)

    return lambda prompts, params: [reply(_user_text(p)) for p in prompts]


def passage_fields(options: dict):
    """Fields made of the line before the prompt's passage with three words of it, the passage, and its digest."""
    keys = options["keys"]

    def reply(prompt: str) -> str:
        head, passage = prompt.split("\nPassage: ", 1)
        query = head.split("\n")[-1] + ": " + " ".join(passage.split(" ")[:3])
        values = (query, passage, hashlib.md5(passage.encode()).hexdigest())
        return json.dumps(dict(zip(keys, values)), ensure_ascii=False)

    return lambda prompts, params: [reply(_user_text(p)) for p in prompts]


def task_list(options: dict):
    """A Python list of two tasks about what the prompt names."""

    def reply(prompt: str) -> str:
        name = prompt.split("about ", 1)[1]
        return str([f"Search for {name}", f"List {name}"])

    return lambda prompts, params: [reply(_user_text(p)) for p in prompts]


def hashed_words(options: dict):
    """Counts of words in ``DIM`` digest buckets."""
    class Buckets(dict):
        def __missing__(self, word: str) -> int:
            if len(self) > 1_000_000:
                self.clear()
            self[word] = found = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % DIM
            return found

    bucket = Buckets().__getitem__

    def run(texts: list[str]) -> np.ndarray:
        """Each different word of a batch is looked up once."""
        words = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        row = np.repeat(np.arange(len(texts)), words.value_lengths().to_numpy())
        coded = words.flatten().dictionary_encode()
        buckets = np.fromiter(map(bucket, coded.dictionary.to_numpy(zero_copy_only=False)), np.int64, len(coded.dictionary))
        return np.bincount(row * DIM + buckets[coded.indices.to_numpy()], minlength=len(texts) * DIM).reshape(-1, DIM).astype(float)

    return run


register_generator("echo_chat", echo_chat)
register_generator("echo_base", echo_base, chat=False)
register_generator("sentence_json", sentence_json)
register_generator("passage_json", passage_json)
register_generator("passage_fields", passage_fields)
register_generator("task_list", task_list)
register_embedder("hashed_words", hashed_words)
