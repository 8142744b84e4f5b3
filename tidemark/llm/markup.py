"""One pass over a page's markup, in time linear in the page, for the operators on pages."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*)")
# What ends a tag, or starts a quoted value in it.
SPECIAL = re.compile(r">|=\s*[\"']")


def closing(*tags: str) -> dict[str, re.Pattern]:
    """Elements whose content is no markup, each with the pattern of its closing tag."""
    return {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in tags}


def markup(page: str, raw: Mapping[str, re.Pattern]) -> Iterator[tuple[str, str, str]]:
    """('text', text, ''), ('open', tag, attributes), ('close', tag, '') and ('gap', '', '')
    for what is dropped, from left to right.

    A tag starts with < and a letter (or / and a letter) and ends at the first > outside
    quoted values; a quote that never closes is an ordinary character, a tag that
    never ends is text, like any other < (but for <! <? and </ up to their >).
    Elements of ``raw`` and comments that are not closed go on to the page's end. No
    part is read twice: where the next value or > lies, and how a tag that meets it
    ends, is remembered."""
    n, at, special, last_gt = len(page), 0, -1, page.rfind(">")
    last = {q: page.rfind(q) for q in "\"'"}
    ends: dict[int, int] = {}  # a special's place outside quotes -> the > that ends the tag, -1: none
    met = None

    def tag_end(p: int) -> int:
        nonlocal special, met
        if special < p:
            met = SPECIAL.search(page, p)
            special = met.start() if met else n
        m, chain, end = met, [], -1
        while m:
            q = m.start()
            if q in ends:
                end = ends[q]
                break
            chain.append(q)
            if page[q] == ">":
                end = q
                break
            opens = m.end() - 1
            after = page.find(page[opens], opens + 1) + 1 if last[page[opens]] > opens else opens + 1
            m = SPECIAL.search(page, after)
        for c in chain:
            ends[c] = end
        return end

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        at = lt
        if page.startswith("<!--", at):
            short = next((k for k in (">", "->") if page.startswith(k, at + 4)), None)
            if short:
                at += 4 + len(short)
            else:
                end = page.find("--", at + 4)
                while end >= 0 and not page.startswith((">", "!>"), end + 2):
                    end = page.find("--", end + 1)
                at = page.find(">", end) + 1 if end >= 0 else n
            yield "gap", "", ""
            continue
        if page.startswith("<![CDATA[", at):
            end = page.find("]]>", at)
            at = end + 3 if end >= 0 else n
            yield "gap", "", ""
            continue
        m = TAG.match(page, at)
        if m:
            tag, end = m[2].lower(), tag_end(m.end())
            if end >= 0:
                if m[1]:
                    yield "close", tag, ""
                elif tag in raw:
                    close = raw[tag].search(page, end + 1)
                    yield "gap", "", ""
                    end = close.end() - 1 if close else n
                else:
                    yield "open", tag, page[m.end():end]
                at = end + 1
                continue
        elif page[at + 1:at + 2] in ("!", "?", "/") and at < last_gt:
            at = page.find(">", at) + 1
            yield "gap", "", ""
            continue
        yield "text", "<", ""
        at += 1
