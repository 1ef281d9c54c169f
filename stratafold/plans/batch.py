"""Batches of files: where files come from and go to, their states, reports and events. A customer is a batch, its orders are
files; web events are progress events."""

from __future__ import annotations

from stratafold.functions.dialect import Dialect
from stratafold.functions.patterns import Rx
from stratafold.plans.registry import query, with_
from stratafold.plans.state import pick, texts
from stratafold.plans.text_layer import tally

#: Events kept per batch; seconds of silence before a heartbeat; states; labels of sources; output root;
#: reasons listed in a report; signs that a safe name keeps.
HISTORY, SILENCE, REASONS = 500, 15, 3
DONE, PARTLY, FAILED = "已完成", "部分完成", "失败"
MIXED, UPLOADED, UPLOAD_LAYER, ROOT = "混合来源", "本地上传", "web_uploads", "output"
UNSAFE = Rx(r"[^\p{L}\p{N}_.\-]+")


def safe_part(d: Dialect, x: str, fallback: str) -> str:
    """A path part without unsafe signs, or the fallback where nothing or only dots are left."""
    bare = d.replace_all(d.replace_all(f"replace(trim({x}), {_back(d)}, '/')", Rx("^/+|/+$")), UNSAFE, "_")
    return f"CASE WHEN {bare} IN ('', '.', '..') THEN {fallback} ELSE {bare} END"


def _back(d: Dialect) -> str:
    return "chr(92)"


def safe_name(d: Dialect, x: str) -> str:
    base = d.replace_all(x, Rx("^.*/"))
    return f"CASE WHEN {d.replace_all(base, UNSAFE, '_')} = '' THEN 'upload.pdf' ELSE {d.replace_all(base, UNSAFE, '_')} END"


def files(d: Dialect) -> dict[str, str]:
    """`task`: a row for each file with name, source, path, state and result."""
    o = "o_orderkey"
    return {
        "task": f"""SELECT o_custkey AS batch_id, {o} AS file_no, {pick(d, o, f"concat('GB ', {o}, ' 标准.pdf')", f"concat('sheet#', {o}, '.PDF')", f"concat('a b/c?', {o}, '.pdf')", "'.pdf'", f"concat('notes', {o}, '.txt')")} AS name,
          {texts(d, o, '', '企业', '企业/2019', '..', ' ./x y ')} AS source_label, {pick(d, o, f"concat('dir one/sub/', {o}, '.pdf')", "''", f"concat('top', chr(92), {o}, '.pdf')", f"concat({o}, '.pdf')")} AS relative_path, {texts(d, 'o_custkey', '本地上传', '文件夹来源', '')} AS said_type, {texts(d, o, '本地上传', '文件夹来源')} AS file_type,
          CASE WHEN o_orderstatus = 'F' THEN '{FAILED}' ELSE '{DONE}' END AS status, o_orderstatus <> 'F' AND {o} % 3 = 0 AS passed, {o} % 5 = 0 AS redline, CASE WHEN o_orderstatus = 'F' OR {o} % 3 = 0 THEN '' ELSE {texts(d, f'{o} + {o} % 4', '正文主链缺失', '疑似扫描件', '总分未达通过线', '表格未消费')} END AS reason,
          {texts(d, 'o_custkey', '', 'reports', 'output/a', '/abs', 'x/../y', ' ')} AS said_root FROM orders"""
    }


def routed(d: Dialect) -> dict[str, str]:
    """`route`: the source layers and folders of a file, from its label and its path."""
    parts = d.split("slashed", "/")
    clean = lambda x: f"transform(filter({x}, p -> p <> ''), (p, i) -> {safe_part(d, 'p', 'concat({0}, i + 1)'.format(d.lit('目录')))})" if d.name == "spark" else f"[{safe_part(d, 'p', '{0}'.format(d.lit('目录')))} FOR p IN {x} IF p <> '']"
    return files(d) | {
        "r0": f"SELECT *, replace(relative_path, {_back(d)}, '/') AS slashed FROM task",
        "route": f"SELECT *, {clean(parts)} AS parts, {safe_name(d, 'name')} AS safe, {safe_part(d, 'source_label', d.lit(UPLOADED))} AS layer FROM r0",
    }


@query
def c08_safe_names(d):
    return with_(files(d), f"SELECT batch_id, file_no, {safe_name(d, 'name')} AS safe_name FROM task")


@query
def c09_safe_parts(d):
    return with_(files(d), f"SELECT batch_id, file_no, {safe_part(d, 'source_label', d.lit(UPLOADED))} AS layer FROM task")


@query
def c10_relative_parts(d):
    return with_(routed(d), f"SELECT batch_id, file_no, {d.joined('parts', '|')} AS parts FROM route")


@query
def c11_output_roots(d):
    """Output folders as given: relative, without a way up, under the output root; others are refused."""
    x = f"CASE WHEN trim(said_root) = '' THEN '{ROOT}' ELSE trim(said_root) END"
    return with_(
        files(d) | {"r": f"SELECT DISTINCT batch_id, {x} AS root FROM task"},
        f"SELECT batch_id, CASE WHEN left(root, 1) = '/' OR {d.search('root', Rx('(^|/)[.][.](/|$)'))} THEN 'refused' ELSE 'taken' END AS verdict, CASE WHEN left(root, 1) = '/' OR {d.search('root', Rx('(^|/)[.][.](/|$)'))} THEN '' WHEN {d.search('lower(root)', Rx('^output(/|$)'))} THEN root ELSE concat('{ROOT}/', root) END AS path FROM r",
    )


@query
def s10_s12_uploads(d):
    """Uploaded files that are PDF, by their cleaned names, with their source layers."""
    return with_(routed(d), f"SELECT batch_id, file_no, safe, layer, right(lower(safe), 4) = '.pdf' AS taken, CASE WHEN {d.size('parts')} > 1 THEN 'folder_picker' ELSE 'file_picker' END AS picked_by FROM route")


def manifests(d: Dialect, said: str) -> dict[str, str]:
    """`ent` from said(batch_id, manifest): the shape of each manifest and its entries in order. A list gives its objects, an
    object those under its files; a manifest that is absent has none, and anything else is refused."""
    listed = d.kept("items", lambda x, _: f"{d.json_kind(x)} = 'OBJECT'", "x", "n")
    return {
        "mf": said,
        "mj": f"SELECT batch_id, coalesce(manifest, '') = '' AS none, {d.parsed_json('manifest')} AS v FROM mf",
        "mk": f"SELECT batch_id, none, v, {d.json_kind('v')} AS kind FROM mj",
        "mi": f"SELECT batch_id, none, kind, CASE WHEN kind = 'ARRAY' THEN {d.json_items('v')} WHEN kind = 'OBJECT' THEN {d.json_items('v', '文件')} END AS items, kind = 'OBJECT' AND NOT {d.json_has('v', '文件')} AS bare, CASE WHEN kind = 'OBJECT' THEN {d.json_text('v', '来源类型')} ELSE '' END AS source_type FROM mk",
        "ent": f"SELECT batch_id, CASE WHEN none THEN 'none' WHEN kind = 'ARRAY' THEN 'list' WHEN kind = 'OBJECT' AND (items IS NOT NULL OR bare) THEN 'object' ELSE 'refused' END AS shape, source_type, CASE WHEN items IS NOT NULL THEN {listed} END AS entries FROM mi",
    }


def aligned(d: Dialect, said: str, uploads: str) -> dict[str, str]:
    """`upl`: uploads(batch_id, place, name) with the manifest's entry at the same place (from 0), if there is one."""
    return manifests(d, said) | {
        "up": uploads,
        "um": f"SELECT u.batch_id, u.place, u.name, e.shape, e.source_type, CASE WHEN e.entries IS NOT NULL THEN {d.get('e.entries', 'u.place')} END AS meta FROM up u JOIN ent e ON u.batch_id = e.batch_id",
        "upl": f"SELECT batch_id, place, shape, source_type, coalesce(nullif(name, ''), nullif({d.json_text('meta', 'original_name')}, ''), concat('upload_', place, '.pdf')) AS original_name, {d.json_text('meta', '相对路径')} AS relative_path, {d.json_text('meta', '来源层')} AS layers, meta IS NOT NULL AS described FROM um",
    }


#: Upload lists by the remainder of a part's key; name stands for its brand.
MANIFESTS = (
    '[{"original_name":"name.pdf","相对路径":"a/b/name.pdf"},3,{"相对路径":"c/x.pdf","来源层":"库/一"}]', '{"来源类型":"网页","文件":[{"original_name":"name"},{"相对路径":"d\\\\e.pdf"}]}', "[]", "not json name", '{"文件":{"name":1}}', '{"来源类型":"本地"}', '"text"', "",
)


@query
def s11_manifests(d):
    """Three uploads for each part, aligned with the entries of its upload list."""
    k = "p_partkey"
    said = f"SELECT {k} AS batch_id, replace(CASE {k} % {len(MANIFESTS)} {' '.join(f'WHEN {i} THEN {d.lit(m)}' for i, m in enumerate(MANIFESTS))} END, 'name', p_brand) AS manifest FROM part"
    files = d.rows(f"(SELECT {k}, p_brand FROM part) p", d.series(3), "n", "", f"{k}, p_brand, n")
    return with_(aligned(d, said, f"SELECT {k} AS batch_id, n - 1 AS place, CASE WHEN ({k} + n) % 4 = 0 THEN '' ELSE concat(p_brand, '-', n, '.pdf') END AS name FROM ({files}) f"), "SELECT batch_id, CAST(place AS BIGINT) AS place, shape, source_type, original_name, relative_path, layers, described FROM upl")


@query
def b06_logical_parents(d):
    """Layers of a file's source and the folders of its path, without the file itself."""
    n = d.size("parts")
    up = f"CASE WHEN {n} > 1 THEN " + ("slice(parts, 1, size(parts) - 1)" if d.name == "spark" else "parts[1:len(parts) - 1]") + " ELSE NULL END"
    return with_(routed(d), f"SELECT batch_id, file_no, CASE WHEN {n} > 1 THEN concat(layer, '/', {d.joined(up, '/')}) ELSE layer END AS parents FROM route")


@query
def k11_output_dirs(d):
    """Output folder of a file: the root, its source layers and folders, and the stem of its name or its number."""
    stem = d.replace_all("safe", Rx(r"(.)\.[^.]*$"), "$1" if d.name == "spark" else r"\1")
    n = d.size("parts")
    up = "slice(parts, 1, size(parts) - 1)" if d.name == "spark" else "parts[1:len(parts) - 1]"
    return with_(routed(d) | {"s": f"SELECT *, {stem} AS stem FROM route"}, f"SELECT batch_id, file_no, concat('{ROOT}/', layer, CASE WHEN {n} > 1 THEN concat('/', {d.joined(up, '/')}) ELSE '' END, '/', CASE WHEN stem = '' THEN concat('f_', file_no) ELSE stem END) AS folder FROM s")


@query
def k11b_folders_under_input(d):
    """Folders of a path after its first part named input, in whatever case."""
    paths = "SELECT s_suppkey, concat(CASE s_suppkey % 3 WHEN 0 THEN '/data/Input/' WHEN 1 THEN 'input/input/' ELSE '/other/' END, replace(s_name, '#', '/'), '/x.pdf') AS path FROM supplier"
    tail = d.replace_all("path", Rx("^(?:.*?/)?input/", True), "//")
    return with_({"p": paths, "t": f"SELECT s_suppkey, path, CASE WHEN {d.search('path', Rx('(?:^|/)input/', True))} THEN {tail} ELSE '' END AS tail FROM p"}, f"SELECT s_suppkey, {d.replace_all(d.replace_all('tail', Rx('^//')), Rx('/?[^/]*$'))} AS folders FROM t")


@query
def b08_batch_status(d):
    """Status of a batch: all its files done, some, or none."""
    done, lost = tally(f"status = '{DONE}'"), tally(f"status = '{FAILED}'")
    return with_(files(d), f"SELECT batch_id, count(*) AS n_files, {done} AS n_done, {lost} AS n_failed, CASE WHEN {lost} = 0 THEN '{DONE}' WHEN {done} = 0 THEN '{FAILED}' ELSE '{PARTLY}' END AS status FROM task GROUP BY batch_id")


@query
def b10_file_states(d):
    return with_(files(d), "SELECT batch_id, file_no, name, status, passed, redline, reason, CASE WHEN status = '失败' THEN '失败' ELSE '完成' END AS phase FROM task")


@query
def a12_percentages(d):
    """Rates of a batch in tenths of a percent, zero where it has no file."""
    share = lambda c: f"CAST(floor(1000.0 * {tally(c)} / greatest(1, count(*)) + 0.5) AS BIGINT)"
    return with_(files(d), f"SELECT batch_id, {share('redline')} AS redline_permille, {share('passed')} AS passed_permille FROM task GROUP BY batch_id")


@query
def a13_source_summary(d):
    """Type and label of a batch's source: those of its files if they agree."""
    one = lambda x: f"CASE WHEN count(DISTINCT {x}) = 1 THEN min({x}) ELSE '{MIXED}' END"
    return with_(files(d) | {"t": f"SELECT batch_id, CASE WHEN said_type <> '' THEN said_type ELSE file_type END AS kind, CASE WHEN source_label = '' THEN '{UPLOADED}' ELSE source_label END AS label FROM task"}, f"SELECT batch_id, {one('kind')} AS source_type, {one('label')} AS source_label FROM t GROUP BY batch_id")


@query
def a13b_layer_summary(d):
    return with_(routed(d) | {"t": f"SELECT batch_id, CASE WHEN source_label = '' THEN '{UPLOAD_LAYER}' ELSE layer END AS label FROM route"}, f"SELECT batch_id, CASE WHEN count(DISTINCT label) = 1 THEN min(label) ELSE '{MIXED}' END AS source_label FROM t GROUP BY batch_id")


@query
def k12_batch_report(d):
    """Counts and rates of a batch and the reasons that its files failed for most often."""
    return with_(
        files(d) | {
            "rs": "SELECT batch_id, reason, count(*) AS n, min(file_no) AS first_no FROM task WHERE reason <> '' GROUP BY batch_id, reason",
            "rk": "SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY n DESC, first_no) AS k FROM rs",
            "top": f"SELECT batch_id, {d.joined(d.list_in_order('concat(reason, {0}, n)'.format(d.lit('×')), 'k'), ', ')} AS reasons FROM rk WHERE k <= {REASONS} GROUP BY batch_id",
            "n": f"SELECT batch_id, count(*) AS n_files, {tally(f'status = {d.lit(DONE)}')} AS n_done, {tally(f'status = {d.lit(FAILED)}')} AS n_failed, {tally('passed')} AS n_passed, {tally(f'status = {d.lit(DONE)} AND NOT passed')} AS n_not_passed, {tally('redline')} AS n_redline FROM task GROUP BY batch_id",
        },
        "SELECT n.*, CAST(floor(1000.0 * n_redline / greatest(1, n_files) + 0.5) AS BIGINT) AS redline_permille, coalesce(reasons, '') AS reasons FROM n LEFT JOIN top ON n.batch_id = top.batch_id",
    )


@query
def b12_event_history(d):
    """The last events of a batch, oldest first out."""
    return with_({"k": "SELECT user_id AS batch_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back FROM events"}, f"SELECT batch_id, event_id, event_type FROM k WHERE back <= {HISTORY}")


@query
def b11_event_counts(d):
    return "SELECT user_id AS batch_id, event_type, count(*) AS n_events, min(event_id) AS first_event, max(event_id) AS last_event FROM events GROUP BY user_id, event_type"


@query
def b17_idle_gaps(d):
    """Heartbeats due: pauses of over fifteen seconds between events of a batch."""
    seconds = "CAST(unix_timestamp(ts) AS BIGINT)" if d.name == "spark" else "CAST(floor(epoch(ts)) AS BIGINT)"
    return with_(
        {"e": f"SELECT user_id, event_id, {seconds} AS s FROM events", "g": "SELECT *, s - lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id) AS gap FROM e"},
        f"SELECT user_id AS batch_id, event_id, gap, CAST(floor(gap / {SILENCE}) AS BIGINT) AS heartbeats FROM g WHERE gap > {SILENCE}",
    )


@query
def k14_event_messages(d):
    """Events as server-sent messages."""
    return with_({"e": f"SELECT event_id, {d.record(event_type='event_type', batch_id='user_id', event_id='event_id')} AS json FROM events"}, f"SELECT event_id, concat({d.lit('event: progress' + chr(10) + 'data: ')}, json, {d.lit(chr(10) + chr(10))}) AS message FROM e")


@query
def w07_previous_turn(d):
    return "SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS after FROM conversations"
