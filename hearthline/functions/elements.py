"""Rules that read fields and links off a page, as SQL expressions over its ``elements`` and ``pieces``. A rule gives a
text, or null. Paths are steps parted by blanks (anywhere below), ``>`` (right below) or ``+`` (right after).

Rules are built as text, for a page's rules are some thousand calls, and each call made of columns is one to the JVM."""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Callable

_MARK = re.compile(r"[.#][\w-]+|\[[^\]]+\]")
_STEP = re.compile(rf"(?P<tag>[a-z][a-z0-9]*)?(?P<marks>(?:{_MARK.pattern})*)")
_names = itertools.count()


def _steps(path: str) -> list[tuple[str, str | None, list[str]]]:
    """(how it hangs on the step before, tag, marks) per step."""
    out, how = [], " "
    for word in re.findall(r"[>+]|(?:\[[^\]]*\]|[^\s>+\[])+", path):
        if word in ">+":
            how = word
            continue
        if (m := _STEP.fullmatch(word)) is None:
            raise ValueError(f"not a step: {word}")
        marks = [re.sub(r"[\[\]'\"]", "", mark) for mark in _MARK.findall(m["marks"])]
        out.append((how, m["tag"], marks))
        how = " "
    return out


def attribute_names(rules) -> frozenset[str]:
    """Attributes that the paths among the rules' arguments ask for."""
    if isinstance(rules, str):
        return frozenset(re.findall(r"\[([\w-]+)", rules))
    return frozenset().union(*map(attribute_names, rules.values() if isinstance(rules, dict) else rules)) if isinstance(rules, dict | tuple | list) else frozenset()


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _over(kind: str, array: str, f: Callable[[str], str]) -> str:
    """transform, filter or exists; f names what it gets as often as it likes."""
    name = f"x{next(_names)}"
    return f"{kind}({array}, {name} -> {f(name)})"


_each, _where = functools.partial(_over, "transform"), functools.partial(_over, "filter")


def _let(value: str, f: Callable[[str], str]) -> str:
    """f of the value, which is worked out once."""
    return f"get({_each(f'array({value})', f)}, 0)"


def _element(pos: str) -> str:
    return f"get(elements, {pos})"


def _inside(e: str) -> str:
    return f"slice(elements, {e}.pos + 2, {e}.end - {e}.pos)"


def _above(e: str, levels: int) -> str:
    for _ in range(levels):
        e = f"{_element(f'{e}.parent')}"
    return e


def _text(e: str, joint: str = "") -> str:
    return f"CASE {e}.last - {e}.first WHEN 1 THEN get(pieces, {e}.first) WHEN 0 THEN '' ELSE array_join(slice(pieces, {e}.first + 1, {e}.last - {e}.first), {quoted(joint)}) END"


def _text_at(pos: str, joint: str = "") -> str:
    return _let(_element(pos), lambda e: _text(e, joint))


def _named(tags: str, within: str = "elements") -> str:
    return _where(within, lambda e: f"{e}.tag IN ({', '.join(map(quoted, tags.split()))})")


def _any(text: str, words, test: str = "contains") -> str:
    return "(" + " OR ".join(f"{test}({text}, {quoted(w)})" for w in words) + ")"


def _first_known(found: str) -> str:
    return f"get(array_compact({found}), 0)"


@functools.cache
def _digits() -> str:
    """Digits of all scripts, also raised, lowered and ringed ones."""
    return quoted(r"[\p{Nd}" + "".join(c for c in map(chr, range(0x20000)) if c.isdigit() and not c.isdecimal()) + "]")


def _fits(e: str, tag: str | None, marks: list[str]) -> str:
    return " AND ".join([*([f"{e}.tag = {quoted(tag)}"] if tag else []), *[f"array_contains({e}.marks, {quoted(m)})" for m in marks]])


def _after(e: str, f: Callable[[str], str]) -> str:
    """f of the element right after e, null where e is its parent's last."""
    return _let(_element(f"{e}.end + 1"), lambda n: f"CASE WHEN {n}.parent = {e}.parent THEN {f(n)} END")


def select(path: str) -> str:
    """Places of what the path leads to, in document order. Each step starts from what the one before found, and reads
    only the elements within."""
    (_, *start), *more = _steps(path)
    found = _each(_where("elements", lambda e: _fits(e, *start)), lambda e: f"{e}.pos")
    for how, *what in more:
        if how == "+":
            found = f"array_compact({_each(found, lambda p: _let(_element(p), lambda e: _after(e, lambda n: f'CASE WHEN {_fits(n, *what)} THEN {n}.pos END')))})"
        else:
            right_below = lambda p: _where("elements", lambda e: f"{e}.parent = {p} AND {e}.pos > {p} AND {_fits(e, *what)}")
            anywhere = lambda p: _let(_element(p), lambda a: _where(_inside(a), lambda e: _fits(e, *what)))
            below = lambda p, found_in=right_below if how == ">" else anywhere: _each(found_in(p), lambda e: f"{e}.pos")
            found = f"array_sort(array_distinct(flatten({_each(found, below)})))"
    return found


# Kinds of rules; each takes the rule's own arguments.
def first(path, nth=0):
    return _text_at(f"get({select(path)}, {nth})")


def nth_of_kind(path, nth):
    """The first match that is its parent's nth child of its tag, from 1."""
    return _text_at(f"get({_where(select(path), lambda p: f'{_element(p)}.nth = {nth}')}, 0)")


def with_next(path):
    """A node's text and that of the node right after it."""
    return _let(_element(f"get({select(path)}, 0)"), lambda e: _after(e, lambda n: f"concat({_text(e)}, {_text(n)})"))


def starts_with_digit(tags, starts):
    return f"get({_where(_each(_named(tags), _text), lambda t: f'{_any(t, starts, "startswith")} AND regexp_like({t}, {_digits()})')}, 0)"


def short_keyword_digit(tags, words, below=50):
    return f"get({_where(_each(_named(tags), _text), lambda t: f'length({t}) < {below} AND {_any(f"lower({t})", words)} AND regexp_like({t}, {_digits()})')}, 0)"


def label_sibling(tag, label, suffix=""):
    """What stands before a label: the sibling of its tag before it, or the other one of two within its parent."""

    def value(e):
        inside = _let(_element(f"{e}.parent"), lambda p: f"slice({_named(tag, _inside(p))}, 1, 3)")
        of_two = _let(inside, lambda x: f"CASE WHEN size({x}) = 2 THEN {_let(f'get({x}, 0)', _text)} END")
        return f"CASE WHEN {e}.before IS NOT NULL THEN {_text_at(f'{e}.before')} ELSE {of_two} END"

    labels = _where(_named(tag), lambda e: f"lower({_text(e)}) = {quoted(label.lower())}")
    return f"concat({_first_known(_each(labels, value))}, {quoted(suffix)})"


def first_with(path, words):
    """The first match, if it holds one of the words."""
    return _let(first(path), lambda t: f"CASE WHEN {_any(f'lower({t})', words)} THEN {t} END")


def contains_any(tags, words, below=None, not_in=(), parent=None):
    """The first text with one of the words that is not a part of the title, which is the first of ``not_in`` with text."""
    title = f"coalesce({', '.join([*map(_filled, map(first, not_in)), quoted('')])})"
    named = _where(_named(tags), lambda e: f"{_element(f'{e}.parent')}.tag = {quoted(parent)}") if parent else _named(tags)
    short = lambda t: f"length({t}) < {below} AND " if below else ""
    return _let(title, lambda whole: f"get({_where(_each(named, _text), lambda t: f'{short(t)}{t} <> {quoted('')} AND {_any(f"lower({t})", words)} AND NOT contains({whole}, {t})')}, 0)")


def marked_box(tag, hints, holds, words):
    """The first ``holds[-1]`` of a box whose classes have all hints and in which all of ``holds`` stand."""
    holding = lambda e: [_over("exists", _inside(e), lambda x, h=h: f"{x}.tag = {quoted(h)}") for h in holds]
    boxes = _where(_named(tag), lambda e: " AND ".join([f"contains({e}.class, {quoted(h)})" for h in hints] + holding(e)))
    return f"get({_where(_each(boxes, lambda e: _let(f'get({_named(holds[-1], _inside(e))}, 0)', _text)), lambda t: _any(f'lower({t})', words))}, 0)"


def class_hint_long(tag, hints, above=100):
    long = _where(_named(tag), lambda e: f"{_any(f'lower({e}.class)', hints)} AND length({_text(e)}) > {above}")
    return _let(f"get({long}, 0)", lambda e: _text(e, "\n"))


def section_after_heading(tag, heading, path):
    def body(e):
        section = f"CASE WHEN {_element(f'{e}.parent')}.tag = 'section' THEN {_element(f'{e}.parent')} ELSE {_above(e, 2)} END"
        return _let(section, lambda s: _text_at(f"get({_where(select(path), lambda p: f'{p} > {s}.pos AND {p} <= {s}.end')}, 0)", "\n"))

    return _first_known(_each(_where(_named(tag), lambda e: f"contains(lower({_text(e)}), {quoted(heading)})"), body))


def container_hint_short(tags, hints, not_words, below=60, levels=3):
    def hinted(box):
        return f"({box}.tag IN ('div', 'aside', 'section') AND {_any(f'lower(concat({box}.class, {box}.id))', hints)})"

    def fits(e):
        boxed = " OR ".join(_let(_above(e, k), hinted) for k in range(1, levels + 1))
        return _let(_text(e), lambda t: f'{t} <> {quoted('')} AND length({t}) < {below} AND NOT {_any(f"lower({t})", not_words)}') + f" AND ({boxed})"

    return _let(f"get({_where(_named(tags), fits)}, 0)", _text)


def link_after_heading(tag, heading, marks, levels=3):
    def link(e):
        return _let(_let(_above(e, levels), lambda box: f"get({_where(_named('a', _inside(box)), lambda a: _any(f'{a}.href', marks))}, 0)"), _text)

    return _first_known(_each(_where(_named(tag), lambda e: f"contains(lower({_text(e)}), {quoted(heading)})"), link))


def canonical():
    return f"{_element(f'get({select("link[rel=canonical]")}, 0)')}.href"


KINDS = {f.__name__: f for f in (first, nth_of_kind, with_next, starts_with_digit, short_keyword_digit, label_sibling, first_with, contains_any, marked_box, class_hint_long, section_after_heading, container_hint_short, link_after_heading, canonical)}


def _filled(text: str) -> str:
    return f"get({_where(f'array({text})', lambda t: f"{t} <> ''")}, 0)"


def field(rules) -> str:
    """The first rule's text that is not empty; a rule is (kind, arguments...)."""
    return f"coalesce({', '.join(_filled(KINDS[kind](*args)) for kind, *args in rules)})"


def links(rules) -> str:
    """Links in order, by kind of card: per card the first, or all."""

    def of_card(card, all_of):
        anchors = f"CASE WHEN {card}.tag = 'a' THEN array({card}) ELSE {_named('a', _inside(card))} END"
        hrefs = _where(_each(anchors, lambda a: f"{a}.href"), lambda h: f"{h} <> ''")
        return hrefs if all_of else f"slice({hrefs}, 1, 1)"

    return f"array({', '.join(f'flatten({_each(select(path), lambda p, all_of=all_of: _let(_element(p), lambda card: of_card(card, all_of)))})' for path, all_of in rules)})"
