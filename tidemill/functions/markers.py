"""What a page is, from the words on it. Lists are in the order in which they are looked through."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import first_marker, from_site, markers_held, normalise, pager, snippet

# The sentences and codes of each kind of page.
APP_ERROR = ("an error occurred processing your request", "please report the error")
BLOCK = (
    "attention required",
    "checking your browser",
    "verify you are human",
    "verifying you are human",
    "are you a robot",
    "unusual traffic",
    "you have been blocked",
    "access denied",
    "request blocked",
    "request rejected",
    "too many requests",
    "error 1010",
    "error 1020",
    "cloudflare",
    "ray id",
    "captcha",
    "ddos protection",
)
GATEWAY = (
    "407 proxy authentication required",
    "proxy authentication required",
    "err_proxy",
    "err_tunnel",
    "err_socks",
    "err_name_not_resolved",
    "err_connection_refused",
    "err_connection_reset",
    "502 bad gateway",
    "503 service unavailable",
    "504 gateway",
    "gateway time-out",
    "gateway timeout",
    "bad gateway",
    "this site can't be reached",
    "the connection was reset",
    "unable to connect",
    "tunnel connection failed",
)
MAINTENANCE = (
    "temporarily unavailable",
    "temporarily out of service",
    "under maintenance",
    "scheduled maintenance",
    "service interruption",
    "we are sorry",
    "please try again later",
)
TIMEOUT = (
    "err_timed_out",
    "deadline exceeded",
    "timeout",
    "i/o timeout",
    "watchdog",
    "never appeared",
    "did not advance",
    "still loading",
    "page did not load",
)
HICCUP = (
    "err_timed_out",
    "err_connection_reset",
    "err_connection_closed",
    "err_connection_aborted",
    "err_networking_changed",
    "err_empty_response",
    "err_socket_not_connected",
    "err_name_not_resolved",
    "err_internet_disconnected",
    "deadline exceeded",
    "context canceled",
    "timeout",
    "i/o timeout",
    "handshake",
    "eof",
    "watchdog",
    "never appeared",
    "did not advance",
    "still loading",
)
FORBIDDEN = r"\b403\b\s*(?:[:\-]\s*)?forbidden"

TERMINAL = ("results", "no results")
FAULTY = ("block", "proxy error", "maintenance", "application error")


@dataclass(frozen=True)
class Site:
    """What tells the searched site's own pages: given by the user, as it is different for each site."""

    control: Sequence[str]  # labels that only the site shows; two of them are proof
    titles: Sequence[str]
    domains: Sequence[str]
    path: str
    no_results: str
    control_core: int = 2


def words(c: Column) -> Column:
    return F.lower(normalise(c))


def app_error(c: Column) -> Column:
    return first_marker(words(c), APP_ERROR).isNotNull()


def forbidden(c: Column) -> Column:
    """Whether 403 and forbidden stand together, in what is not JSON."""
    text = words(c)
    return ~text.rlike(r"^[{\[]") & text.rlike(FORBIDDEN)


def classify(url: Column, title: Column, text: Column, grid_rows: Column, pager_text: Column, site: Site) -> Column:
    """struct(kind, marker): the first that holds of application error, maintenance, proxy error, block, proxy error by title, results, no results, monitor; else unknown.

    Sentences of failures go before the proof that a grid is there, so a row that holds one is read as that failure: apply it to pages,
    never to data.
    """
    low, head = words(F.coalesce(text, F.lit(""))), words(F.coalesce(title, F.lit("")))
    control = [m.lower() for m in site.control]
    name = lambda listed: F.coalesce(*[F.when(F.contains(low, F.lit(m.lower())), F.lit(m)) for m in listed], F.lit("title and url"))
    proof = pager(pager_text)
    decided = lambda kind, marker: F.struct(F.lit(kind).alias("kind"), marker.alias("marker"))
    chain = None
    for kind, source, listed in (("application error", low, APP_ERROR), ("maintenance", low, MAINTENANCE), ("proxy error", low, GATEWAY), ("block", low, BLOCK), ("proxy error", head, GATEWAY)):
        marker = first_marker(source, listed)
        shown = F.concat(F.lit("title: "), marker) if source is head else marker
        chain = (F if chain is None else chain).when(marker.isNotNull(), decided(kind, shown))
    rows = F.concat(grid_rows.cast("string"), F.lit(' rows, pager "'), F.trim(pager_text), F.lit('"'))
    chain = chain.when((grid_rows > 0) & proof.isNotNull(), decided("results", rows))
    chain = chain.when(F.contains(low, F.lit(site.no_results.lower())), decided("no results", F.lit(site.no_results)))
    own = (markers_held(low, control) >= site.control_core) | (first_marker(head, [t.lower() for t in site.titles]).isNotNull() & from_site(url, site.domains, site.path))
    return chain.when(own, decided("monitor", name(site.control))).otherwise(decided("unknown", F.lit("")))


def faulty(kind: Column) -> Column:
    """Whether a page of this kind is an error that the attempt ends with."""
    return F.coalesce(kind.isin(*FAULTY), F.lit(False))


def terminal(kind: Column) -> Column:
    """Whether a page of this kind ends the search: there are results, or there are none."""
    return F.coalesce(kind.isin(*TERMINAL), F.lit(False))


def page_fault(kind: Column, marker: Column, text: Column, where: str | Column, shown: int = 200) -> Column:
    """A page's error as struct(kind, marker, where, snippet), with the step at which it was met; null for a page that is no error, or is not decided yet."""
    at = F.lit(where) if isinstance(where, str) else where
    return F.when(faulty(kind), F.struct(kind.alias("kind"), marker.alias("marker"), at.alias("where"), snippet(text, shown).alias("snippet")))


def graded(status: Column, body: Column) -> Column:
    """A response's grade: blocked, http_error, ok (JSON), app_error or not_json."""
    peek = F.regexp_replace(body, r"^[\x{FEFF} \t\r\n]+", "")
    return F.when(status == 403, "blocked").when(status != 200, "http_error").when(peek.rlike(r"^[{\[]"), "ok").when(forbidden(peek), "blocked").when(app_error(peek), "app_error").otherwise("not_json")


def timed_out(error: Column) -> Column:
    return F.coalesce(first_marker(F.lower(error), TIMEOUT).isNotNull(), F.lit(False))


def hiccup(error: Column) -> Column:
    return F.coalesce(first_marker(F.lower(error), HICCUP).isNotNull(), F.lit(False))
