"""Model clients as injected factories: one client for each Python worker, nothing secret in a plan."""

from __future__ import annotations

import hashlib
import itertools
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_credentials(path: str) -> tuple[str, str, str]:
    """(endpoint, api_key, deployment_name) from the `openai` section of a small YAML file."""
    found: dict[str, str] = {}
    section = None
    with open(path, encoding="utf-8") as f:
        for line in f:
            text = line.split("#")[0].rstrip()
            if not text:
                continue
            key, _, value = text.strip().partition(":")
            if not line.startswith((" ", "\t")):
                section = key
            elif section == "openai":
                found[key.strip()] = value.strip().strip("'\"")
    try:
        return found["endpoint"], found["api_key"], found["deployment_name"]
    except KeyError as e:
        raise ValueError(f"{path} lacks openai.{e.args[0]}") from e


class Budget:
    """A token bucket that the threads of a task share: `rate` requests a second, of which up to a second's worth may be saved up."""

    def __init__(self, rate: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.rate, self.clock, self.sleep, self.lock = rate, clock, sleep, threading.Lock()
        self.room, self.at = min(1.0, rate), clock()

    def take(self) -> None:
        """Waits until a request is due: each caller is given a time of its own."""
        with self.lock:
            now = self.clock()
            self.room = min(max(1.0, self.rate), self.room + (now - self.at) * self.rate)
            self.at = now
            self.room -= 1
            wait = -self.room / self.rate if self.room < 0 else 0.0
        if wait:
            self.sleep(wait)


def ask(
    df: DataFrame,
    prompt: str,
    reply: str,
    factory: Callable[[], Callable[[str], str]],
    threads: int = 5,
    pause: float = 0.0,
    tasks: int | None = None,
    per_second: float | None = None,
    retries: int = 0,
    back_off: float = 0.5,
) -> DataFrame:
    """Adds `reply`: factory() makes a client in the worker, which answers a batch's prompts on `threads` threads; a failure is null.

    The rows are dealt to `tasks` tasks, if given; that many times `threads` requests are under way at most. `per_second`
    limits the requests of all tasks together: each task has a bucket with its share of it, so tasks that run later leave
    their share unused rather than exceed it. A request that fails is sent again up to `retries` times, after waits of `back_off`
    seconds that double; every try takes from the budget. Each thread waits `pause` seconds after a prompt.
    Tasks that run again ask again: see sources.ledger for replies that are kept.
    """
    names = df.columns
    if per_second and not tasks:
        tasks = df.sparkSession.sparkContext.defaultParallelism
    dealt = df.repartition(tasks) if tasks else df

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = None
        budget = Budget(per_second / tasks) if per_second else None
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                client = client or factory()

                def one(text: str) -> str | None:
                    try:
                        for attempt in range(retries + 1):
                            if budget:
                                budget.take()
                            try:
                                return client(text)
                            except Exception:  # whatever a client raises counts as no reply
                                if attempt < retries:
                                    time.sleep(back_off * 2**attempt)
                        return None
                    finally:
                        time.sleep(pause)

                got = list(pool.map(one, batch.column(prompt).to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.string())], names=[*names, reply])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return dealt.mapInArrow(run, f"{kinds}, `{reply}` string")


def missing(asked: DataFrame, stored: DataFrame | None, keys: list[str]) -> DataFrame:
    """The rows of `asked` without a reply in `stored`; a null reply counts as none."""
    return asked if stored is None else asked.join(stored.where(F.col("reply").isNotNull()).select(*keys), keys, "left_anti")


_LOADED: dict[str, object] = {}


def sentence_encoder(model: str, batch_size: int = 64) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    """A factory of encoders by a named sentence-transformers model, which a worker loads once."""

    def factory() -> Callable[[list[str]], np.ndarray]:
        if model not in _LOADED:
            from sentence_transformers import SentenceTransformer  # an optional package

            _LOADED[model] = SentenceTransformer(model)

        def encode(texts: list[str]) -> np.ndarray:
            if not texts:
                return np.zeros((0, 0), np.float32)
            return np.asarray(_LOADED[model].encode(texts, batch_size=batch_size, show_progress_bar=False), np.float32)

        return encode

    return factory


#: Trigrams whose places an encoder remembers.
TRIGRAMS = 1 << 17


def hashing_encoder(dimension: int = 64) -> Callable[[list[str]], np.ndarray]:
    """An encoder that needs no model: hashed character trigrams. The place and sign of a trigram are found once and remembered."""
    known: dict[str, int] = {}

    def place(gram: str) -> int:
        h = int.from_bytes(hashlib.blake2b(gram.encode(), digest_size=8).digest(), "little")
        return h % dimension if h >> 63 else h % dimension - dimension  # below 0: minus

    def encode(texts: list[str]) -> np.ndarray:
        sizes = [max(1, len(t) - 2) for t in texts]
        grams = [t[i : i + 3] for t, n in zip(texts, sizes) for i in range(n)]
        if new := set(grams).difference(known):
            if len(known) + len(new) > TRIGRAMS:
                known.clear()
                new = set(grams)
            known.update((g, place(g)) for g in new)
        at = np.fromiter(map(known.__getitem__, grams), np.int64, len(grams))
        row = np.repeat(np.arange(len(texts)), sizes)
        sums = np.bincount(row * dimension + at % dimension, weights=np.where(at < 0, -1.0, 1.0), minlength=len(texts) * dimension)
        return sums.reshape(len(texts), dimension).astype(np.float32)

    return encode


def by_length(texts: list[str], encode: Callable[[list[str]], np.ndarray], tokens: int) -> list[np.ndarray]:
    """The vectors of the texts, in their order: encoded from short to long, in batches of at most `tokens` padded words.

    A batch costs its longest text times its number of texts; a longer text is a batch of its own.
    """
    sizes = [max(1, len(t.split())) for t in texts]
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(texts)
    held: list[int] = []
    for i in [*sorted(range(len(texts)), key=lambda k: (sizes[k], k)), None]:
        if held and (i is None or sizes[i] * (len(held) + 1) > tokens):
            for k, v in zip(held, encode([texts[k] for k in held])):
                out[k] = v
            held = []
        if i is not None:
            held.append(i)
    return out


def embed(text: Column, factory: Callable[[], Callable[[list[str]], np.ndarray]] = hashing_encoder, window: int = 4, tokens: int = 16_384) -> Column:
    """array<float> of a text by an encoder made once for each task; null texts count as empty.

    Texts are sorted by length over `window` Arrow batches, so that those encoded together are about equally long.
    """

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = factory()
        while held := list(itertools.islice(batches, window)):
            found = iter(by_length([t for b in held for t in b.fillna("").tolist()], encode, tokens))
            for b in held:
                yield pd.Series(list(itertools.islice(found, len(b))), dtype=object)

    return run(text)
