"""Prompt templates: own neutral wording around the fixed wire format.

The answer shapes and the wrappers around the packed items are a contract with
the answer parser. The wording is a default; every job takes other templates.
"""

from __future__ import annotations

_ARGUMENT_RULE = (
    "Judge only whether the post argues. Tone, spelling and truth do not matter. "
    "Answer with one item per post:\n"
)
_STANCE_RULE = (
    "Judge only the position of the reply. Tone, spelling and truth do not matter. "
    "Answer with one item per reply:\n"
)

# The answer item each strategy asks for.
_ARGUMENT_ITEM = "[id: <id>, annotation: (argumentative/not argumentative)]"
_ARGUMENT_ITEM_WHY = (
    "[id: <id>, annotation: The response is (argumentative/not argumentative) "
    "because: (brief justification)]"
)
_STANCE_ITEM = '[id: <id>, annotation: "FOR/AGAINST/NEUTRAL"]'
_STANCE_ITEM_WHY = (
    '[id: <id>, annotation: "The response is FOR/AGAINST/NEUTRAL because: '
    '(short justification)"]'
)

_ARGUMENT_SHOTS = """
Example:
Tweets: [
[id: 1, text: "The bridge should stay closed, because two cables are worn."],
[id: 2, text: "The bridge is closed today."],
]
"""
_STANCE_SHOTS = """
Example:
[[Tweet: "The library should open on Sundays.", Replies: [
[id: 1, text: "Yes, many people only have time then."],
[id: 2, text: "No, the staff need a free day."],
]]]
"""

STRATEGIES = {
    "AM_CoT": _ARGUMENT_RULE + _ARGUMENT_ITEM_WHY,
    "AM_Shots": _ARGUMENT_RULE + _ARGUMENT_ITEM + _ARGUMENT_SHOTS
    + 'Output: [\n[id: 1, annotation: "argumentative"],\n'
    + '[id: 2, annotation: "not argumentative"]\n]',
    "AM_Shots_CoT": _ARGUMENT_RULE + _ARGUMENT_ITEM_WHY + _ARGUMENT_SHOTS
    + 'Output: [\n[id: 1, annotation: "The response is argumentative because: a reason is given."],\n'
    + '[id: 2, annotation: "The response is not argumentative because: it only reports."]\n]',
    "SD_CoT": _STANCE_RULE + _STANCE_ITEM_WHY,
    "SD_Shots": _STANCE_RULE + _STANCE_ITEM + _STANCE_SHOTS
    + 'Output: [\n[id: 1, annotation: "FOR"],\n[id: 2, annotation: "AGAINST"]\n]',
    "SD_Shots_CoT": _STANCE_RULE + _STANCE_ITEM_WHY + _STANCE_SHOTS
    + 'Output: [\n[id: 1, annotation: "The response is FOR because: it agrees."],\n'
    + '[id: 2, annotation: "The response is AGAINST because: it disagrees."]\n]',
}

ARGUMENT_SYSTEM = (
    "You label posts as argumentative or not argumentative. A post is argumentative "
    "when it takes a position and supports it with at least one reason, stated or "
    "clearly implied.\n{}"
)
STANCE_SYSTEM = (
    "You label how a reply stands to the main point of the post it answers: FOR when "
    "it agrees, AGAINST when it objects, NEUTRAL when the post makes no point or the "
    "reply does not take a side.\n\n{}\n"
)

# What encloses the packed items.
ARGUMENT_USER = "Label these posts:\nTweets: [\n{}\n]\n"
STANCE_USER = "Label these replies, given the posts they answer:\n{}\n"
