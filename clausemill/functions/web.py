"""Scalars of the fetch side: URLs, sizes, states, and what to do with a document. Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def work_item_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"(?i)WKI_ID=(\d+)", 1), F.lit(""))


def clean_url(url: Column) -> Column:
    """A URL without its empty query parameters."""
    base, query = F.substring_index(url, "?", 1), F.regexp_extract(url, r"\?(.*)$", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.rlike(r"^[^=]*=?$")), "&")
    return F.when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept))


def url_class(url: Column) -> Column:
    low = F.lower(url)
    return F.when(low.contains("/deliver/"), "delivery").when(low.contains("docbox"), "docbox").when(low.contains("/pda/"), "pda").otherwise("portal")


def size_text(n: Column) -> Column:
    return F.when(n < 1024, F.format_string("%d B", n)).when(n < 1024 * 1024, F.format_string("%.1f KB", n / 1024)).otherwise(F.format_string("%.1f MB", n / (1024 * 1024)))


def safe_name(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_"), r"_{2,}", "_")


def intact(content_length: Column, stored: Column, least: int = 1000) -> Column:
    """Stored bytes are plausible, and as many as were announced where that is known."""
    return (stored >= least) & F.coalesce(stored == content_length, F.lit(True))


def fetch_action(whole: Column, forced: Column, headers_only: Column, fresh: Column, state: Column) -> Column:
    """What to do next with a document, by the first rule that holds."""
    return (
        F.when(~whole, "download").when(forced, "download")
        .when(headers_only & (state == "changed"), "report-changed").when(headers_only, "skip")
        .when(fresh, "skip").when(state == "same", "refresh").otherwise("download")
    )


def format_choice(docx_bytes: Column, pdf_bytes: Column, enough: int = 20_000) -> Column:
    return F.when(docx_bytes >= enough, "docx").when(pdf_bytes > 0, "pdf").otherwise("unknown")


def short_title(answer: Column) -> Column:
    """A generated title made usable: first line, no thinking, bullets or quotes, four words at most; null if it rambles."""
    c = F.regexp_replace(answer, r"(?is)<think>.*?</think>", "")
    line = F.regexp_replace(F.split(F.regexp_replace(c, r"^\s+", ""), "\n")[0], r"^[\s\-*•\"'„“”]+|[\s\"'„“”.]+$", "")
    words = F.filter(F.split(line, r"\s+"), lambda w: w != "")
    return F.when(F.size(words).between(1, 8), F.array_join(F.slice(words, 1, 4), " "))


def absolute_url(url: Column, base: str) -> Column:
    """A URL with its host, without empty query parameters."""
    full = F.when(url.rlike(r"(?i)^https?://"), url).when(url.startswith("/"), F.concat(F.lit(base.rstrip("/")), url)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), url))
    return clean_url(full)


def editable_link(links: Column, delivery: str = "/deliver", host: str = "etsi.org", not_in: str = "eApproval") -> Column:
    """The link to a document that can be edited: a .docx, a .doc that is no ballot paper, an archive of the delivery area, or
    any archive of the host, in this order, the first of each."""
    hrefs = F.transform(links, lambda x: F.trim(x["href"]))
    first = lambda test: F.try_element_at(F.filter(hrefs, test), F.lit(1))
    low = F.lower
    return F.coalesce(
        first(lambda h: low(h).endswith(".docx")), first(lambda h: low(h).endswith(".doc") & ~h.contains(not_in)),
        first(lambda h: h.contains(delivery) & low(h).endswith(".zip")), first(lambda h: h.contains(host) & low(h).endswith(".zip")),
    )


def status_after(html: Column, marker: str = "<!-- Status Last Update -->", window: int = 500) -> Column:
    """The first bold text within `window` characters after a marker; null without either."""
    after = F.when(F.instr(html, marker) > 0, F.substr(html, F.instr(html, marker) + len(marker), F.lit(window)))
    return F.nullif(F.trim(F.regexp_extract(after, r"<(?:b|nobr)(?:\s[^>]*)?>([^<]+)</(?:b|nobr)>", 1)), F.lit(""))


def comment_field(html: Column, name: str) -> Column:
    """The value of a header comment <!-- name: value -->; null without one, or if it's unknown."""
    v = F.trim(F.regexp_extract(html, rf"<!--\s*{name}:\s*(.*?)\s*-->", 1))
    return F.when(~v.isin("", "unknown"), v)


def publication_title(title: Column, series: str = r"Electronic Signatures and (?:Trust )?Infrastructures \(ESI\);?") -> Column:
    """A title without the name of its series, blanks squeezed; null if nothing is left."""
    c = F.regexp_replace(F.regexp_replace(title, rf"(?i)^{series}\s*", ""), r"\s*-\s*OpenID Foundation$", "")
    return F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def plain_text_title(text: Column, head: int = 80) -> Column:
    """The title of a plain-text standard: the first line after its number that is none of the other fields."""
    lines = F.filter(F.transform(F.slice(F.split(text, r"\r?\n"), 1, head), F.trim), lambda x: x != "")
    at = F.array_position(F.transform(lines, lambda x: x.rlike(r"(?i)^request for comments:\s*\d+")), True).cast("int")
    rest = F.filter(F.slice(lines, F.greatest(at, F.lit(0)) + 1, F.greatest(F.size(lines), F.lit(1))), lambda x: ~x.rlike(r"(?i)^(category|issn|updates|obsoletes):"))
    return F.when(at > 0, publication_title(F.try_element_at(rest, F.lit(1))))


# Where each body's documents are found.
_OPENID = (("4VCI", "openid-4-verifiable-credential-issuance-1_0.html"), ("HAIP", "openid4vc-high-assurance-interoperability-profile-1_0.html"), ("4VP", "openid-4-verifiable-presentations-1_0.html"), ("4VC", ""), ("Connect", "openid-connect-core-1_0.html"))


def document_url(ref: Column, source: Column, known: Column) -> Column:
    """Where a cited document is found: its known URL, else its body's page or search; null for other bodies."""
    rfc, iso = F.regexp_extract(ref, r"(?i)RFC\s*(\d+)", 1), F.regexp_extract(ref, r"(?i)ISO\s*([\d-]+)", 1)
    itu = F.regexp_extract(ref, r"(?i)ITU-T\s*([A-Z])\d+", 1), F.regexp_extract(ref, r"(?i)ITU-T\s*[A-Z](\d+)", 1)
    openid = F.lit("https://openid.net/developers/specs/")
    for word, page in reversed(_OPENID):
        openid = F.when(ref.contains(word), f"https://openid.net/specs/{page}").otherwise(openid)
    draft = lambda name: F.lit(f"https://datatracker.ietf.org/doc/draft-ietf-oauth-{name}/")
    return F.coalesce(
        F.when(source == "spec", F.coalesce(known, F.concat(F.lit("https://www.etsi.org/standards#page=1&search="), F.url_encode(ref)))),
        F.when((source == "ietf") & (rfc != ""), F.concat(F.lit("https://datatracker.ietf.org/doc/html/rfc"), rfc)),
        F.when((source == "ietf") & ref.contains("SD-JWT VC"), draft("sd-jwt-vc")), F.when((source == "ietf") & ref.contains("SD-JWT"), draft("selective-disclosure-jwt")),
        F.when((source == "iso") & (iso != ""), F.concat(F.lit("https://www.iso.org/search.html?q="), F.url_encode(iso))),
        F.when((source == "itu") & (itu[0] != ""), F.concat(F.lit("https://www.itu.int/rec/T-REC-"), F.upper(itu[0]), F.lit("."), itu[1])),
        F.when(source == "w3c", "https://www.w3.org/TR/"), F.when(source == "openid", openid),
    )


def cache_line(headers: Column) -> Column:
    """What is known of a download on one line, without what isn't."""
    part = lambda name, key: F.concat(F.lit(f"{name}: "), headers[key])
    return F.concat_ws(" | ", part("etag", "etag"), part("modified", "last-modified"), part("size", "content-length"), part("fetched", "x-downloaded-at"))
