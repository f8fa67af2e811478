"""Model back ends over planned windows, with bounded retries."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = "window_id int, vlm_json string, attempts int, status string"


class Backend(Protocol):
    name: str

    def warmup(self) -> None: ...
    def infer(self, frame_ids: list[int], prompt: str) -> dict: ...
    def cleanup(self) -> None: ...


class Dummy:
    """A cut in the middle for more than eight images, else none."""

    name = "dummy"

    def warmup(self) -> None:
        pass

    def infer(self, frame_ids: list[int], prompt: str) -> dict:
        n = len(frame_ids)
        return {"transitions": [n // 2], "instructions": ["First task", "Second task"]} if n > 8 else {"transitions": [], "instructions": ["Single task"]}

    def cleanup(self) -> None:
        pass


class Remote:
    """Sends frames and prompt over a transport, a function from a request to a (status, body) pair."""

    name = "remote"

    def __init__(self, transport: Callable[[dict], tuple[int, dict]]):
        self.transport = transport

    def warmup(self) -> None:
        pass

    def infer(self, frame_ids: list[int], prompt: str) -> dict:
        status, body = self.transport({"frame_ids": frame_ids, "prompt": prompt})
        return body if status == 200 and isinstance(body, dict) else {}

    def cleanup(self) -> None:
        pass


BACKENDS: dict[str, Callable[..., Backend]] = {"dummy": Dummy, "remote": Remote}


def backend(name: str, *args) -> Backend:
    if name not in BACKENDS:
        raise ValueError(f"no back end {name}; there are {sorted(BACKENDS)}")
    return BACKENDS[name](*args)


def dummy_answers(windows: DataFrame) -> DataFrame:
    """The dummy back end as plain columns: transitions and labels of each window."""
    n = F.size("frame_ids")
    many = n > 8
    return windows.withColumns({"transitions": F.when(many, F.array((n / 2).cast("int"))).otherwise(F.array().cast("array<int>")), "labels": F.when(many, F.array(F.lit("First task"), F.lit("Second task"))).otherwise(F.array(F.lit("Single task")))})


def prompt(n_images: Column, targets: list[str], mode: str, context: Column | None = None) -> Column:
    """Our own instructions for the model: what to mark, in which form to answer, and the known subtasks."""
    ask = {"coarse": "frames where the handled object changes", "fine": "frames where the phase of the action changes"}[mode]
    want = {"subtask": f'"transitions" (indices of {ask}) and "instructions" (one for each span)', "memory": '"summaries" and "change_event_types" (one for each span) and "transitions"'}
    text = F.format_string("You see %d frames in order. Answer with one JSON object: " + "; ".join(f"{t}: {want[t]}" for t in targets) + ".", n_images)
    return F.concat_ws("\n", text, context) if context is not None else text


def annotate(windows: DataFrame, make: Callable[[], Backend], keys: list[str], tries: int = 3) -> DataFrame:
    """keys, window_id, vlm_json, attempts, status (done or failed) of each window; windows: keys, window_id, frame_ids, prompt.

    A back end is made and warmed up once a partition. An empty answer or an exception is tried again, up to `tries`.
    """
    kinds = dict(windows.dtypes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        model.warmup()
        try:
            for frame in frames:
                out = []
                for ids, text in zip(frame["frame_ids"], frame["prompt"]):
                    answer, n = {}, 0
                    while not answer and n < tries:
                        n += 1
                        try:
                            answer = model.infer([int(i) for i in ids], text)
                        except Exception:  # noqa: BLE001  a model's failure is an empty answer
                            answer = {}
                    out.append((json.dumps(answer), n, "done" if answer else "failed"))
                yield frame[[*keys, "window_id"]].assign(vlm_json=[x[0] for x in out], attempts=[x[1] for x in out], status=[x[2] for x in out])
        finally:
            model.cleanup()

    return windows.mapInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", " + RESULT)


def parsed_answers(results: DataFrame, keys: list[str], labels: str = "instructions") -> DataFrame:
    """keys, window_id, transitions, labels from the answers' JSON; elements that are no numbers are skipped."""
    from tracewright.functions.scalar import payload

    v = payload(F.try_parse_json("vlm_json"), "memory" if labels == "summaries" else "subtask")
    whole = F.coalesce(F.try_variant_get(v, "$.transitions", "array<string>"), F.array().cast("array<string>"))
    numbers = F.array_compact(F.transform(whole, lambda x: x.try_cast("double").cast("int")))
    return results.select(*keys, "window_id", numbers.alias("transitions"), F.coalesce(F.try_variant_get(v, f"$.{labels}", "array<string>"), F.array().cast("array<string>")).alias("labels"))
