"""Client and server redirects (SC-08, SC-09) and the redirect comparison
of a change pair (RED-01)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changelens.functions import urls as U

# A refresh meta tag, and its "N[.N]; url=TARGET" content.
META_REFRESH_RE = r'<meta[^>]+http-equiv="refresh"[^>]*'
META_REFRESH_URL_RE = r'content="\d+(\.\d*)?;\s*url=([^"]+)"'


def client_redirect(body: Column) -> Column:
    """SC-08: target of the first ``<meta http-equiv="refresh">``, else null."""
    tag = F.regexp_extract(body, META_REFRESH_RE, 0)
    return F.nullif(F.regexp_extract(tag, META_REFRESH_URL_RE, 2), F.lit(""))


def all_redirects(server: Column, client: Column) -> Column:
    """SC-09: server hops followed by the client target (when there is one)."""
    return F.concat(F.coalesce(server, F.array().cast("array<string>")),
                    F.when(client.isNotNull(), F.array(client)).otherwise(F.array().cast("array<string>")))


def final_url(redirects: Column, url: Column) -> Column:
    return F.coalesce(F.try_element_at(redirects, F.lit(-1)), url)


def compare(a_url: Column, a_server: Column, a_client: Column,
            b_url: Column, b_server: Column, b_client: Column) -> Column:
    """RED-01 as a struct: change_type of the final destinations, changed,
    client_changed, client_state ('' | 'still' | 'was redirect' |
    'became redirect'), both server chains and both client targets."""
    a_all, b_all = all_redirects(a_server, a_client), all_redirects(b_server, b_client)
    ct = U.url_change_type(final_url(a_all, a_url), final_url(b_all, b_url))
    state = (F.when(a_client.isNotNull() & b_client.isNotNull(), F.lit("still"))
             .when(a_client.isNotNull(), F.lit("was redirect"))
             .when(b_client.isNotNull(), F.lit("became redirect"))
             .otherwise(F.lit("")))
    return F.struct(
        ct.alias("change_type"),
        ct.isNotNull().alias("changed"),
        (~a_client.eqNullSafe(b_client)).alias("client_changed"),
        state.alias("client_state"),
        F.coalesce(a_server, F.array().cast("array<string>")).alias("a_server"),
        F.coalesce(b_server, F.array().cast("array<string>")).alias("b_server"),
        a_client.alias("a_client"),
        b_client.alias("b_client"),
    )
