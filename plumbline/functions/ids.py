"""Stable keys: reviewer pseudonyms, row keys, URL and payload hashes."""

from __future__ import annotations

import hmac

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.constants import MIN_SALT_CHARS, REVIEW_ID_VERSION, TRACKING_QUERY_KEYS

_URL = r"^([A-Za-z][A-Za-z0-9+.\-]*):(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(?:#.*)?$"
_WEB = r"^(?i)(https?|ftp|wss?)$"
_DEFAULT_PORTS = [("http|ws", 80), ("https|wss", 443), ("ftp", 21)]


def check_salt(salt: str) -> str:
    if salt is None or len(salt) < MIN_SALT_CHARS:
        raise ValueError(f"salt must have at least {MIN_SALT_CHARS} characters")
    return salt


def pseudonymize(reviewer: Column, salt: str) -> Column:
    """Keyed SHA-256 of the reviewer id.

    The key lives in the function's closure only: written as SQL expressions it
    would show up in query plans and event logs.
    """
    key = check_salt(salt).encode()

    @F.arrow_udf("string")
    def keyed_hash(ids: pa.Array) -> pa.Array:
        out = []
        for value in ids.to_pylist():
            if value == "":
                raise ValueError("reviewer id must not be empty")
            out.append(None if value is None else hmac.digest(key, value.encode(), "sha256").hex())
        return pa.array(out, pa.string())

    return keyed_hash(reviewer)


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def review_id(
    marketplace: Column,
    native_id: Column,
    store: Column,
    product: Column,
    reviewer_hash: Column,
    text_hash: Column,
    review_ts: Column,
) -> Column:
    """A native id alone identifies a review, so a rewrite keeps its row; without
    one the content is part of the key."""
    version = F.lit(REVIEW_ID_VERSION)
    has_native = F.coalesce(F.length(native_id) > 0, F.lit(False))
    material = F.when(has_native, F.concat_ws("|", version, marketplace, native_id)).otherwise(
        F.concat_ws(
            "|", version, marketplace, store, product, reviewer_hash, text_hash, iso_millis(review_ts)
        )
    )
    return F.sha2(material, 256)


def is_url(url: Column) -> Column:
    scheme = F.regexp_extract(url, _URL, 1)
    host = F.regexp_extract(url, _URL, 2)
    return (
        url.rlike(_URL)
        & (~scheme.rlike(_WEB) | ((host != "") & ~host.rlike(r"[\s<>\\^|]")))
        & F.try_parse_url(F.regexp_replace(url, r"[\s\"<>\\^`{|}\[\]]", "_"), F.lit("PROTOCOL")).isNotNull()
    )


def _form_value(text: Column) -> Column:
    return F.url_encode(F.coalesce(F.try_url_decode(text), text))


def canonical_url(url: Column) -> Column:
    """Drop the fragment and tracking parameters; an unusable URL is an error.

    Scheme and host are lower-cased and a default port goes, as URL parsers do.
    The query is only re-encoded when something was removed from it.
    """
    names = ("scheme", "authority", "path", "query")
    parts = F.struct(url.alias("url"), *[F.regexp_extract(url, _URL, i + 1).alias(n) for i, n in enumerate(names)])
    # Bound as the one element of an array: the parts are used many times below,
    # and as plain expressions would be generated as often.
    return F.when(url.isNotNull(), F.transform(F.array(parts), _rebuilt)[0])


def _rebuilt(parts: Column) -> Column:
    scheme, authority, path, query = F.lower(parts["scheme"]), parts["authority"], parts["path"], parts["query"]
    is_web = scheme.rlike(_WEB)
    user = F.regexp_extract(authority, r"^(.*@)?", 1)
    server = F.concat(scheme, F.lit("://"), user, F.lower(F.regexp_replace(authority, r"^.*@", "")))
    for schemes, port in _DEFAULT_PORTS:
        server = F.regexp_replace(server, f"^((?:{schemes})://.*):{port}$", "$1")
    slashes = F.when(parts["url"].rlike("^[^:]+://"), F.concat(F.lit("//"), authority)).otherwise("")
    head = F.when(is_web, F.regexp_replace(server, ":$", "")).otherwise(F.concat(scheme, F.lit(":"), slashes))
    web_path = F.when(is_web & (path == ""), "/").otherwise(path)

    pairs = F.filter(F.split(F.substring(query, 2, 2**31 - 1), "&"), lambda p: p != "")
    kept = F.transform(F.filter(pairs, lambda p: ~_is_tracking(p)), _form_pair)
    rebuilt = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    new_query = F.when(F.exists(pairs, _is_tracking), rebuilt).otherwise(query)
    return F.when(is_url(parts["url"]), F.concat(head, web_path, new_query)).otherwise(
        F.raise_error(F.concat(F.lit("not a URL: "), parts["url"]))
    )


def _is_tracking(pair: Column) -> Column:
    raw = F.substring_index(pair, "=", 1)
    key = F.lower(F.coalesce(F.try_url_decode(raw), raw))
    return key.startswith("utm_") | key.isin(TRACKING_QUERY_KEYS)


def _form_pair(pair: Column) -> Column:
    key = F.substring_index(pair, "=", 1)
    value = F.substring(pair, F.length(key) + 2, F.length(pair))
    return F.concat(_form_value(key), F.lit("="), _form_value(value))


def url_hash(url: Column) -> Column:
    return F.sha2(canonical_url(url), 256)


def payload_hash(
    marketplace: Column,
    native_id: Column,
    store: Column,
    product: Column,
    stars: Column,
    text: Column,
    ts_text: Column,
    url: Column,
    has_media: Column,
    language: Column,
) -> Column:
    """SHA-256 of the input object without the reviewer. Absent values stay as
    null, except the language which is left out."""
    fields = [
        marketplace.alias("marketplace"),
        native_id.alias("native_review_id"),
        store.alias("store_id"),
        product.alias("product_id"),
        stars.alias("star_rating"),
        text.alias("comment_text"),
        ts_text.alias("review_ts"),
        url.alias("source_url"),
        has_media.alias("has_media"),
    ]
    keep_nulls = {"ignoreNullFields": "false"}
    plain = F.to_json(F.struct(*fields), keep_nulls)
    tagged = F.to_json(F.struct(*fields, language.alias("language_hint")), keep_nulls)
    return F.sha2(F.when(language.isNull(), plain).otherwise(tagged), 256)


def product_path(url: Column) -> Column:
    """``struct(store_id, product_id)`` from a ``/s/{store}/.../p/{product}`` path, else NULL.

    The store is the first filled part behind an ``s``. The product is the first filled part behind a ``p`` that has at
    least one part between itself and the store.
    """
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.regexp_extract(url, "^[^?#]*", 0))
    parts = F.split(path, "/")
    places = F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1)))

    def behind(mark: str, least: Column) -> Column:
        """Place of the first filled part behind ``mark``, from ``least`` on."""
        named = lambda i: (F.get(parts, i - 1) == mark) & (F.length(F.get(parts, i)) > 0)
        return F.get(F.filter(places, lambda i: (i >= least) & (i > 1) & named(i)), 0)

    store = behind("s", F.lit(1))
    product = behind("p", store + 3)
    return F.when(product.isNotNull(), F.struct(F.get(parts, store).alias("store_id"), F.get(parts, product).alias("product_id")))


def local_day_to_ts(day: Column, offset: str) -> Column:
    """Midnight of a calendar day at a fixed UTC offset; NULL for impossible dates."""
    return F.try_to_timestamp(F.concat(day, F.lit(f"T00:00:00{offset}")))
