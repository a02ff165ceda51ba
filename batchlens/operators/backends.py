"""Model slots: what a scoring task calls, and rule-based stand-ins for tests.

A backend factory takes no argument and runs once per task. It returns a
function ``(inputs, options) -> outputs`` with one output per input, in order.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any, BinaryIO

Model = Callable[[list[str], Any], list[Any]]
Backend = Callable[[], Model]


@dataclass(frozen=True)
class Sampling:
    """How text is sampled; None leaves a value to the model server."""

    temperature: float | None = None
    top_p: float | None = None
    max_tokens: int = 500
    n: int = 1


# The option sets of the flows.
BATCH_SAMPLING = Sampling(temperature=0.1, top_p=0.6, max_tokens=150)
LONG_SAMPLING = Sampling(temperature=0.1, top_p=0.6, max_tokens=250)
SERVER_SAMPLING = Sampling(max_tokens=500)
CAPTION_QUESTION = "What product is this an image of? Describe in detail!"


@dataclass(frozen=True)
class Recognition:
    """Speech recogniser options."""

    window_seconds: int = 30
    batch_size: int = 24
    timestamps: bool = True


@dataclass(frozen=True)
class Speakers:
    """Bounds on the number of speakers; ``exact`` overrides them."""

    at_least: int = 1
    at_most: int = 6
    exact: int | None = None


@dataclass(frozen=True)
class Captioning:
    question: str = CAPTION_QUESTION
    max_tokens: int = 128


# ---------------------------------------------------------------------------
# Stand-ins. They follow rules and are not models.

_ASKED = re.compile(r"(spell|definition of) '([^']+)'")


def rule_text() -> Model:
    """Answers spelling and definition questions, and sizes up anything else."""

    def answer(prompt: str) -> str:
        asked = _ASKED.search(prompt)
        if asked is None:
            return f"The prompt has {len(prompt)} characters."
        word = asked.group(2)
        if asked.group(1) == "spell":
            return "-".join(word.upper())
        return f"A definition of {word} is not known to a rule."

    def run(prompts: list[str], options: Sampling) -> list[list[str]]:
        return [
            [" ".join(answer(p).split(" ")[: options.max_tokens])] * options.n for p in prompts
        ]

    return run


# Characters a stand-in speaker utters in a second.
SPEECH_RATE = 15.0


def _timed(script: str, separator: str) -> list[tuple[str, float, float]]:
    pieces, spoken = [], 0
    for piece in script.split(separator):
        pieces.append((piece, spoken / SPEECH_RATE, (spoken + len(piece)) / SPEECH_RATE))
        spoken += len(piece)
    return pieces


def script_reader(separator: str = "\n") -> Backend:
    """Stand-in recogniser: the input is the script of what is said, one chunk
    per line, at a steady rate. The end of the last chunk stays open."""

    def make() -> Model:
        def run(scripts: list[str], options: Recognition) -> list[list[dict]]:
            transcripts = []
            for script in scripts:
                chunks = [
                    {"text": text, "timestamp": [start, end]}
                    for text, start, end in _timed(script, separator)
                ]
                chunks[-1]["timestamp"][1] = None
                transcripts.append(chunks)
            return transcripts

        return run

    return make


def windowed_reader() -> Model:
    """Stand-in recogniser that hears ``window_seconds`` at a time: a chunk per
    window, without times if they are not asked for. The last end stays open."""

    def run(scripts: list[str], options: Recognition) -> list[list[dict]]:
        width = max(1, round(options.window_seconds * SPEECH_RATE))
        transcripts = []
        for script in scripts:
            texts = [script[at : at + width] for at in range(0, len(script), width)] or [""]
            times = [[k * width / SPEECH_RATE, (k + 1) * width / SPEECH_RATE] for k in range(len(texts))]
            times[-1][1] = None
            if not options.timestamps:
                times = [[None, None]] * len(texts)
            transcripts.append([{"text": t, "timestamp": s} for t, s in zip(texts, times)])
        return transcripts

    return run


def script_speakers(separator: str = "\n") -> Backend:
    """Stand-in diarizer: one segment per piece of the script, the speaker told
    from the length of the piece."""

    def make() -> Model:
        def run(scripts: list[str], options: Speakers) -> list[list[dict]]:
            def voices(pieces: int) -> int:
                if options.exact or options.at_least <= 1:
                    return options.exact or options.at_most
                return max(options.at_least, min(options.at_most, pieces))

            return [
                [
                    {
                        "segment": {"start": start, "end": end},
                        "track": "A",
                        "label": f"SPEAKER_{len(text) % voices(len(pieces)):02d}",
                    }
                    for text, start, end in pieces
                ]
                for pieces in (_timed(script, separator) for script in scripts)
            ]

        return run

    return make


def path_caption() -> Model:
    """Stand-in captioner: names the file after repeating the question."""

    def run(paths: list[str], options: Captioning) -> list[str]:
        captions = [f"{options.question} A picture named {p.rsplit('/', 1)[-1]}." for p in paths]
        return [" ".join(c.split(" ")[: options.max_tokens]) for c in captions]

    return run


def table_rows() -> Callable[[list[bytes | BinaryIO], None], list[int]]:
    """Stand-in that sees contents, as bytes or open files: rows of a table file, by
    its closing bytes."""
    import io

    import pyarrow.parquet as pq

    def rows(content: bytes | BinaryIO) -> int:
        return pq.read_metadata(io.BytesIO(content) if isinstance(content, bytes) else content).num_rows

    return lambda contents, options: [rows(c) for c in contents]
