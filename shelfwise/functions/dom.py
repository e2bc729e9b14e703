"""A page as its elements, by one pass over its tags, in expressions inside one record.

``on_page`` cuts a page into tags and text with possessive patterns: no match steps back, no group calls
itself, so time is linear whatever a tag holds (megabyte values, missing quotes, missing ends). It then
walks the tags once with a stack and gives every element its parent, its own end and the number of elements
below it. Elements stand in page order, so what lies inside one is a slice behind it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions import text as tx

#: What a page does not show.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!doctype[^>]*>"
#: What follows a tag's name: anything but < and >, where only a value may hold these, in quotes.
_REST = r"""(?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
TAG = rf"</?[a-zA-Z]{_REST}"
TOKEN = rf"(?s){TAG}|<[!?][^>]*+>|[^<]++|<"
_VALUE = r"""(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+))"""
#: Elements without content, and elements that the next one of their kind ends unless one of the last list lies between.
EMPTY = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
ENDED_BY_NEXT = ["a", "dd", "dt", "li", "option", "p", "td", "th", "tr"]
SCOPES = ["table", "ul", "ol", "dl", "select"]
#: Elements that end an open paragraph.
ENDS_P = ["div", "dl", "form", "h1", "h2", "h3", "h4", "h5", "h6", "ol", "section", "table", "ul"]
#: Tags of one inner walk: every step of a walk copies its state, so what is found meets the rest once per walk only.
_BLOCK = 128

_ENTRY = "struct<o:int,name:string,parent:int,open:int,h3:int,h2:int>"
NODE = f"{_ENTRY[:-1]},close:int,size:int>"


def attribute(tag: Column | str, name: str) -> Column:
    """Value of a tag's attribute as it is written: in double quotes, in single ones or bare; '' without one."""
    other = rf"""[\s/]*+(?!{name}[\s=/>])[^\s=>/"']++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+"""
    pattern = rf"(?is)^<[a-z][^\s/>]*+(?:{other})*+[\s/]*+{name}\s*+=\s*+{_VALUE}"
    return F.concat(*[F.regexp_extract(tx.col(tag), pattern, k) for k in (1, 2, 3)])


def has_class(tag: Column | str, *classes: str) -> Column:
    """Does a tag carry one of the classes, as a whole word?"""
    tag = tx.col(tag)
    words = "|".join(c.replace("-", r"\-") for c in classes)
    return tag.rlike(r"(?i)class") & attribute(tag, "class").rlike(rf"(?:^|\s)(?:{words})(?:\s|$)")


def _quoted(*texts: str) -> str:
    """SQL literals."""
    return ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in texts)


def _let(name: str, value: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _last_place(test: str) -> str:
    """Place from 1 of the top entry e of the stack that passes; 0 without one."""
    return f"coalesce(array_max(transform(s.stack, (e, j) -> CASE WHEN {test} THEN j + 1 END)), 0)"


def _ended(entries: str, close: str, count: str) -> str:
    """Elements that end here, as JSON text: a walk copies its state at every step, and text is copied fastest."""
    whole = f"named_struct('o', x.o, 'name', x.name, 'parent', x.parent, 'open', x.open, 'h3', x.h3, 'h2', x.h2, 'close', {close}, 'size', {count} - x.o - 1)"
    return f"CASE WHEN size({entries}) > 0 THEN to_json(transform({entries}, x -> {whole})) ELSE '' END"


def _step() -> str:
    """One tag m on a state s: end what it ends, then open what it opens."""

    def in_scope(test: str) -> str:
        return _let("at", _last_place(test), f"CASE WHEN at > {_last_place(f'e.name IN ({_quoted(*SCOPES)})')} THEN at ELSE 0 END")

    # Place in the stack from which on the tag ends what is open; 0 if it ends nothing.
    cut = f"""CASE WHEN m.closing AND try_element_at(s.stack, -1).name = m.name THEN size(s.stack)
        WHEN m.closing THEN {_last_place("e.name = m.name")}
        WHEN m.name IN ({_quoted(*ENDED_BY_NEXT)}) THEN {in_scope("e.name = m.name")}
        WHEN m.name IN ({_quoted(*ENDS_P)}) THEN {in_scope("e.name = 'p'")} ELSE 0 END"""
    below = "CASE WHEN cut > 0 THEN slice(s.stack, 1, cut - 1) ELSE s.stack END"
    done = f"CASE WHEN cut > 0 THEN concat(s.done, {_ended('slice(s.stack, cut, size(s.stack))', 'm.i', 's.n')}) ELSE s.done END"
    entry = """named_struct('o', s.n, 'name', m.name, 'parent', coalesce(try_element_at(below, -1).o, -1), 'open', m.i,
        'h3', CAST(NULL AS INT), 'h2', CAST(NULL AS INT))"""
    headed = """CASE WHEN m.name IN ('h2', 'h3') THEN transform(below, e -> named_struct('o', e.o, 'name', e.name, 'parent', e.parent,
        'open', e.open, 'h3', coalesce(e.h3, CASE WHEN m.name = 'h3' THEN s.n END), 'h2', coalesce(e.h2, CASE WHEN m.name = 'h2' THEN s.n END)))
        ELSE below END"""
    moved = f"""CASE WHEN m.closing THEN named_struct('stack', below, 'done', {done}, 'n', s.n)
        WHEN m.empty THEN named_struct('stack', {headed}, 'done', concat({done}, {_ended(f"array({entry})", "m.i", "s.n + 1")}), 'n', s.n + 1)
        ELSE named_struct('stack', array_append({headed}, {entry}), 'done', {done}, 'n', s.n + 1) END"""
    return _let("cut", cut, _let("below", below, moved))


def _page(html: str) -> str:
    """SQL of struct(tokens, nodes) of a markup column.

    As text, because a walk of this size is parsed in a moment but takes seconds to put together call by call.
    """
    mark = rf"""CASE WHEN k RLIKE {_quoted("^</?[a-zA-Z]")} AND endswith(k, '>') THEN {_let("name",
        f"lower(regexp_extract(k, {_quoted('^</?([a-zA-Z][a-zA-Z0-9_:-]*+)')}, 1))",
        f"named_struct('i', i, 'name', name, 'closing', startswith(k, '</'), 'empty', endswith(k, '/>') OR name IN ({_quoted(*EMPTY)}))")} END"""
    walked = f"""aggregate(b, named_struct('stack', p.stack, 'done', '', 'n', p.n), (s, m) -> {_step()})"""
    blocks = f"transform(sequence(0, (size(marks) - 1) div {_BLOCK}), c -> slice(marks, CAST(c * {_BLOCK} + 1 AS INT), {_BLOCK}))"
    joined = "named_struct('stack', r.stack, 'done', concat(p.done, r.done), 'n', r.n)"
    start = f"named_struct('stack', CAST(array() AS array<{_ENTRY}>), 'done', '', 'n', 0)"
    told = f"aggregate({blocks}, {start}, (p, b) -> {_let('r', walked, joined)}, p -> concat(p.done, {_ended('p.stack', 'size(t)', 'p.n')}))"
    nodes = f"""CASE WHEN size(marks) > 0 THEN sort_array(from_json(replace({told}, '][', ','), {_quoted(f"array<{NODE}>")}))
        ELSE CAST(array() AS array<{NODE}>) END"""
    tokens = f"regexp_extract_all(regexp_replace({html}, {_quoted(HIDDEN)}, ''), {_quoted(TOKEN)}, 0)"
    return _let("t", tokens, _let("marks", f"array_compact(transform(t, (k, i) -> {mark}))", f"named_struct('tokens', t, 'nodes', {nodes})"))


def on_page(html: str, body: Callable[[Column, Column], Column]) -> Column:
    """``body(tokens, nodes)`` of a column of markup, by its name; each is computed once.

    Tokens are the tags and texts that the page shows, in order. Nodes are ARRAY<STRUCT>, the elements in page order:
    ``o`` is an element's index, ``parent`` its parent's (-1 without), ``open`` and ``close`` the places of its tags
    among the tokens, ``size`` the number of elements inside, ``h3`` and ``h2`` the first such headings inside.
    A closing tag without an open partner says nothing; one that ends an outer element ends the inner ones too;
    what is never closed reaches to the end of its parent or the page. Of a NULL page there are none.
    """
    return tx.let(F.expr(_page(f"`{html}`")), lambda page: body(page["tokens"], page["nodes"]))


def tag_of(found: Column, node: Column) -> Column:
    """An element's opening tag."""
    return F.get(found, node["open"])


def inside(all_nodes: Column, node: Column) -> Column:
    """The elements within an element, in page order."""
    return F.slice(all_nodes, node["o"] + 2, node["size"])


def markup_of(found: Column, node: Column) -> Column:
    """What stands between an element's tags."""
    return F.array_join(F.slice(found, node["open"] + 2, F.greatest(node["close"] - node["open"] - 1, F.lit(0))), "")
