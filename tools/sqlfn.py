"""DuckDB SQL text for the scalar functions, used only by the oracle SQL.

Each builder takes SQL expressions (strings) and returns an SQL expression.
"""

from __future__ import annotations

from changelens.functions import urls as U


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def part(u, g):
    return f"regexp_extract({u}, {q(U.URL_RE)}, {g})"


def is_valid(u):
    return f"coalesce(regexp_matches({u}, {q(U.URL_RE)}), FALSE)"


def host(u):
    return f"regexp_replace(lower({part(u, 4)}), '^[^@]*@', '')"


def _canon_parts(u):
    lu = f"lower(trim({u}))"
    h = f"regexp_replace(regexp_replace(regexp_replace({part(lu, 4)}, '^[^@]*@', ''), ':(80|443)?$', ''), '^www\\d*\\.', '')"
    p0 = part(lu, 5)
    p1 = f"(CASE WHEN {p0} = '' THEN '/' ELSE {p0} END)"
    p = f"(CASE WHEN length({p1}) > 1 AND ends_with({p1}, '/') THEN regexp_replace({p1}, '/$', '') ELSE {p1} END)"
    q0 = part(lu, 7)
    qq = f"(CASE WHEN {q0} = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split({q0}, '&')), '&') END)"
    return lu, h, p, qq


def canonical_key(u):
    lu, h, p, qq = _canon_parts(u)
    rev = f"array_to_string(list_reverse(string_split({h}, '.')), ',')"
    return f"(CASE WHEN {is_valid(lu)} AND {h} <> '' THEN {rev} || ')' || {p} || {qq} END)"


def canonical_url(u):
    lu, h, p, qq = _canon_parts(u)
    return f"({part(lu, 2)} || '://' || {h} || {p} || {qq})"


def key_host(k):
    return f"split_part({k}, ')', 1)"


def key_path(k):
    return f"regexp_extract({k}, '^[^)]*\\)(.*)$', 1)"


def is_home_path(p):
    pp = f"regexp_replace(coalesce({p}, ''), '[?#].*$', '')"
    return f"(CASE WHEN {pp} = '' THEN TRUE ELSE regexp_matches({pp}, {q(U.HOME_PATH_RE)}) END)"


def is_home_page(u):
    return is_home_path(part(u, 5))


def let(name, value, body):
    return f"([{body} FOR {name} IN [{value}]])[1]"


def dot_segments(p):
    """A name stays unless the folder depth falls below its own further on
    (depth: running balance of names and '..', never under the root)."""
    bal = "[list_sum(stp[1:i]) FOR i IN range(1, len(stp) + 1)]"
    dep = "[bal[i] - least(0, list_min(bal[1:i])) FOR i IN range(1, len(bal) + 1)]"
    kept = "[seg[i] FOR i IN range(1, len(seg) + 1) IF stp[i] = 1 AND list_min(dep[i:]) >= dep[i]]"
    slash = "CASE WHEN regexp_matches(pth, '/\\.{1,2}$') THEN '/' ELSE '' END"
    out = f"CASE WHEN len(kpt) = 0 THEN '/' ELSE '/' || array_to_string(kpt, '/') || {slash} END"
    for name, value in (("kpt", kept), ("dep", dep), ("bal", bal),
                        ("stp", "[CASE s WHEN '..' THEN -1 WHEN '.' THEN 0 ELSE 1 END FOR s IN seg]"),
                        ("seg", "string_split(substring(pth, 2), '/')"), ("pth", f"regexp_extract({p}, '^[^?#]*')")):
        out = let(name, value, out)
    return f"({out} || regexp_extract({p}, '[?#].*$'))"


def bare(href):
    """No tabs and line breaks anywhere, no characters up to the blank at the ends."""
    low = "||".join(f"chr({i})" for i in range(1, 33))
    return f"trim(translate({href}, chr(9) || chr(10) || chr(13), ''), {low})"


def absolute_url(base, href):
    body = f"""CASE WHEN xh IS NULL THEN NULL
      WHEN regexp_matches(xh, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN xh
      WHEN starts_with(xh, '//') THEN {part('xb', 1)} || xh
      WHEN starts_with(xh, '?') THEN xo || {part('xb', 5)} || xh
      WHEN starts_with(xh, '#') THEN regexp_replace(xb, '#.*$', '') || xh
      WHEN xh = '' THEN regexp_replace(xb, '#.*$', '')
      ELSE xo || {dot_segments('xt')} END"""
    b_dir = f"regexp_replace(CASE WHEN {part('xb', 5)} = '' THEN '/' ELSE {part('xb', 5)} END, '[^/]*$', '')"
    for name, value in (("xt", f"CASE WHEN starts_with(xh, '/') THEN xh ELSE {b_dir} || xh END"),
                        ("xo", f"({part('xb', 1)} || '//' || {part('xb', 4)})"), ("xh", bare(href)), ("xb", base)):
        body = let(name, value, body)
    return body


def remove_session_id(u):
    keys = "[" + ", ".join(q(k) for k in U.SESSION_QUERY_KEYS) + "]"
    kept = f"array_to_string([kv FOR kv IN string_split(sq, '&') IF kv <> '' AND NOT list_contains({keys}, lower(split_part(kv, '=', 1)))], '&')"
    body = """split_part(sn, '?', 1) || (CASE WHEN contains(sn, '?') AND sk <> '' THEN '?' || sk ELSE '' END)
      || regexp_extract(sx, '(#.*)$', 1)"""
    path = f"regexp_replace(regexp_replace({u}, {q(U.SERVLET_SESSION_RE)}, ''), {q(U.ASP_SESSION_RE)}, '/')"
    for name, value in (("sk", kept), ("sq", "regexp_extract(sn, '^[^?]*\\?(.*)$', 1)"),
                        ("sn", "regexp_replace(sx, '#.*$', '')"), ("sx", path)):
        body = let(name, value, body)
    return body


def normalize_url(href, base):
    wf = "(nc || CASE WHEN nf <> '' THEN '#' || nf ELSE '' END)"
    body = f"""CASE WHEN nh = '#' THEN '#'
      WHEN NOT {is_valid('na')} OR {host('na')} = '' THEN nr
      WHEN nf <> '' AND nc = {canonical_url('nb')} THEN '#' || nf
      ELSE {remove_session_id('nw')} END"""
    for name, value in (("nw", f"regexp_replace({wf}, '^http:', 'https:')"), ("nc", canonical_url("na")),
                        ("nf", "regexp_extract(na, '#(.*)$', 1)"), ("na", absolute_url("nb", "nh")),
                        ("nh", bare("nr")), ("nr", href), ("nb", base)):
        body = let(name, value, body)
    return body


def url_change_type(a, b):
    """By lists instead of the pattern: [host, folder] of each key."""
    def parts(k):
        segs = f"string_split(split_part({k}, '?', 1), '/')"
        ok = f"contains(split_part({k}, '?', 1), ')') AND len({segs}) > 1 AND NOT starts_with({k}, ')')"
        head = f"array_to_string(({segs})[1:-2], '/')"
        return f"CASE WHEN {ok} THEN [split_part({head}, ')', 1), substring({head}, length(split_part({head}, ')', 1)) + 2)] END"

    body = """CASE WHEN ka IS NOT DISTINCT FROM kb THEN NULL WHEN pa IS NULL OR pb IS NULL THEN 'path'
      WHEN pa[1] <> pb[1] THEN 'domain' WHEN pa[2] <> pb[2] THEN 'path' ELSE 'name' END"""
    for name, value in (("pb", parts("kb")), ("pa", parts("ka")), ("kb", canonical_key(b)), ("ka", canonical_key(a))):
        body = let(name, value, body)
    return body


# ---------------------------------------------------------------- status, gates, redirects
from changelens.functions import gates as G  # noqa: E402
from changelens.functions import redirects as R  # noqa: E402
from changelens.functions import status as ST  # noqa: E402


def arr(items):
    return "[" + ", ".join(q(x) for x in items) + "]"


def client_redirect(body):
    tag = f"regexp_extract({body}, {q(R.META_REFRESH_RE)}, 0)"
    return f"nullif(regexp_extract({tag}, {q(R.META_REFRESH_URL_RE)}, 2), '')"


def all_redirects(server, client):
    return (f"(coalesce({server}, CAST([] AS VARCHAR[])) || "
            f"CASE WHEN {client} IS NOT NULL THEN [{client}] ELSE CAST([] AS VARCHAR[]) END)")


def final_url(redirects, url):
    return f"coalesce({redirects}[-1], {url})"


def base_status(status, network_error):
    return (f"coalesce(nullif({status}, 0), CASE WHEN coalesce({network_error}, '') <> '' THEN 600 ELSE 200 END)")


def title_status(title):
    msgs = arr(ST.STANDARD_STATUS_MESSAGES)
    rules = "\n".join(f"WHEN regexp_matches(s, {q(p)}) THEN {c}" for p, c in ST.TITLE_RULES)
    sec = (f"CASE WHEN list_contains({msgs}, s) THEN CAST(split_part(s, ' ', 1) AS INTEGER) "
           f"WHEN regexp_matches(s, {q(ST.TITLE_CODE_RE)}) THEN CAST(regexp_extract(s, {q(ST.TITLE_CODE_RE)}, 1) AS INTEGER) "
           f"{rules} END")
    return (f"list_filter(list_transform(list_transform(regexp_split_to_array(lower({title}), {q(ST.TITLE_SPLIT_RE)}), "
            f"lambda x: trim(x)), lambda s: {sec}), lambda c: c IS NOT NULL)[1]")


def effective_status(url, status, network_error, title, redirects, apex="NULL"):
    base = base_status(status, network_error)
    t = f"coalesce({title}, '')"
    has = f"(coalesce(len({redirects}), 0) > 0)"
    last = f"{redirects}[-1]"
    ku, kd = canonical_key(url), canonical_key(last)
    home_rule = (f"({has} AND {key_host(ku)} = {key_host(kd)} AND NOT {is_home_path(key_path(ku))} "
                 f"AND {is_home_path(key_path(kd))})")
    differ = f"({has} AND {ku} IS DISTINCT FROM {kd})"
    f500 = " OR ".join(f"contains(coalesce({url}, ''), {q(h)})" for h in ST.FALSE_500_HOSTS)
    ov = ""
    for src, dest, code in ST.DEFAULT_STATUS_OVERRIDES:
        cond = f"{differ} AND {kd} = {q(dest)}" + (f" AND {key_host(ku)} = {q(src)}" if src else "")
        ov += f" WHEN coalesce({cond}, FALSE) THEN {code}"
    ts = title_status(t)
    return f"""CAST(CASE WHEN {base} = 500 AND ({f500}) AND NOT contains({t}, '500') THEN 200
      WHEN {base} >= 400 THEN {base}
      WHEN coalesce({home_rule}, FALSE) THEN 404 {ov}
      WHEN {ts} IS NOT NULL THEN {ts}
      WHEN contains(lower(coalesce({apex}, '')), 'level=error') THEN 500
      WHEN {has} AND coalesce(regexp_matches({last}, {q(ST.ASPX_ERROR_RE)}), FALSE) THEN 500
      ELSE {base} END AS INTEGER)"""


def error_type(e):
    return f"(CASE WHEN {e} >= 600 THEN 'network' WHEN {e} >= 500 THEN 'server' WHEN {e} >= 400 THEN 'user' END)"


def status_factor(a, b):
    ea, eb = error_type(a), error_type(b)
    return (f"(CASE WHEN {ea} IS NULL OR {eb} IS NULL THEN 1.0 WHEN {ea} = {eb} THEN {ST.SAME_ERROR_FACTOR} "
            f"ELSE {ST.OTHER_ERROR_FACTOR} END)")


def is_fetchable(u):
    return f"(starts_with(coalesce({u}, ''), 'http:') OR starts_with(coalesce({u}, ''), 'https:'))"


def is_allowed_extension(u):
    e = f"regexp_extract({part(u, 5)}, '[^/](\\.[^./]+)$', 1)"
    return f"({e} = '' OR NOT list_contains({arr(G.DISALLOWED_EXTENSIONS)}, {e}))"


def is_analyzable_media(m, u):
    return (f"(CASE WHEN {m} IS NOT NULL AND {m} <> '' THEN list_contains({arr(G.ALLOWED_MEDIA)}, {m}) OR "
            f"(starts_with({m}, 'text/') AND NOT list_contains({arr(G.DISALLOWED_MEDIA)}, {m})) "
            f"ELSE {is_allowed_extension(_coalesce_empty(u))} END)")


def is_content_analyzable(u):
    return f"NOT coalesce(regexp_matches(lower({u}), {q(G.METADATA_ONLY_RE)}), FALSE)"


def is_news_page(u, t):
    return (f"(coalesce(regexp_matches(lower({u}), {q(G.NEWS_URL_RE)}), FALSE) OR "
            f"coalesce(regexp_matches(lower({t}), {q(G.NEWS_TITLE_RE)}), FALSE))")


def _coalesce_empty(u):
    return f"coalesce({u}, '')"
