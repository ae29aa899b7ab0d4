"""Column expressions for ids, URLs, prompt text and labels. All run in the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from threadloom.templates import STRATEGIES

# Characters str.strip() removes. Java's Unicode \s covers them
# except the four separators U+001C to U+001F.
_BLANK = r"[\s\x{1c}-\x{1f}]"


def url_tail(url: Column) -> Column:
    """Last '/'-separated segment; empty when the URL ends in a slash."""
    return F.element_at(F.split(url, "/"), -1)


def safe_id(value: Column) -> Column:
    """BIGINT id, or null where the text is not one."""
    return value.try_cast("bigint")


def strip(text: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.regexp_replace(text, rf"(?U)^{_BLANK}+|{_BLANK}+\z", "")


def prompt_text(text: Column, null_text: str | None = "nan") -> Column:
    """Text as it goes into a prompt: double quotes turned single, nulls named."""
    quoted = F.replace(text.cast("string"), F.lit('"'), F.lit("'"))
    return quoted if null_text is None else F.coalesce(quoted, F.lit(null_text))


def item_line(item_id: Column, text: Column) -> Column:
    """One prompt item. Fixed format; ``text`` is already a prompt text."""
    return F.concat(
        F.lit("[id: "), item_id.cast("string"), F.lit(', text: "'), text, F.lit('"],\n')
    )


def fill(template: str, body: Column) -> Column:
    """Put ``body`` where the template says {}."""
    head, slot, tail = template.partition("{}")
    if not slot:
        raise ValueError("template has no {} slot")
    return F.concat(F.lit(head), body, F.lit(tail))


def system_prompt(
    strategy: Column, template: str, strategies: Mapping[str, str] = STRATEGIES
) -> Column:
    """System prompt per row, its strategy looked up by name; null when unknown."""
    pairs = [F.lit(part) for item in strategies.items() for part in item]
    return fill(template, F.try_element_at(F.create_map(*pairs), strategy))


def argument_label(answer: Column) -> Column:
    """argumentative / not_argumentative from free text, null when neither.

    The positive word is part of the negative one, and a justification may
    name the other label, so the first mention decides, with its negation.
    """
    mention = F.lower(
        F.regexp_extract(answer, r"(?i)\b((?:not|non)[\s-]+|non)?argumentative\b", 0)
    )
    return F.when(mention == "argumentative", "argumentative").when(
        mention != "", "not_argumentative"
    )


def stance_label(answer: Column) -> Column:
    """FOR / AGAINST / NEUTRAL: the first one named, null when none is."""
    mention = F.regexp_extract(answer, r"\b(FOR|AGAINST|NEUTRAL)\b", 1)
    return F.when(mention != "", mention)
