"""A repeatable stand-in for a model: answers by a rule on the ids in the prompt."""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle

# Python workers need not have this package installed to run the stand-in.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ASKED = re.compile(r'^\[id: (\d+), text: "', re.MULTILINE)

STANCES = {0: "FOR", 1: "AGAINST", 2: "NEUTRAL"}
ARGUMENTS = {0: "argumentative", 1: "not argumentative"}


def _asked(prompt: str) -> list[int]:
    return [int(item) for item in _ASKED.findall(prompt)]


def stance_model():
    """FOR / AGAINST / NEUTRAL in turn, every fourth id left out."""

    def answer(prompt: str, system: str) -> str:
        items = []
        for i in _asked(prompt):
            label = STANCES.get((i // 1000 + i) % 4)
            if label:
                items.append(
                    f'[id: {i}, annotation: "The response is {label} because: reply {i} [sic] says so."]'
                )
        return "[\n" + ",\n".join(items) + "\n]"

    return answer


def argument_model():
    """Argumentative or not in turn, unquoted, every third id left out."""

    def answer(prompt: str, system: str) -> str:
        items = []
        for i in _asked(prompt):
            label = ARGUMENTS.get(i % 3)
            if label:
                items.append(f"[id: {i}, annotation: The response is {label} because: of post {i}]")
        return "[\n" + ",\n".join(items) + "\n]"

    return answer


def brief_argument_model():
    """The first label for every id, without a reason."""
    return lambda prompt, system: ", ".join(f"[id: {i}, annotation: {ARGUMENTS[0]}]" for i in _asked(prompt))


def failing_argument_model():
    """As above, but fails on batches whose first id is 3 modulo 7."""
    answer = argument_model()

    def fail_or_answer(prompt: str, system: str) -> str:
        if _asked(prompt)[0] % 7 == 3:
            raise TimeoutError("model did not answer")
        return answer(prompt, system)

    return fail_or_answer
