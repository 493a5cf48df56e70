"""Named pieces of the queries.  A piece in a dict has one form for Spark and one for the SQL oracle."""

LINK = '<a [^>]*href="([^"]*)"'

#: Licence and origin of a derived sprite.
SPRITE_LICENSE = "CASE id%3 WHEN 0 THEN 'public_domain' WHEN 1 THEN 'cc-by' ELSE 'private_train' END"
SPRITE_URL = "concat('https://art.example/\u00e9/', CAST(id AS STRING))"

#: Derived sprites (id, kind, k, w0, h0), one for each part: w0 x h0 pixels drawn k times as large.
SPRITE_SIZES = """
SELECT p_partkey AS id, p_partkey%10 AS kind,
 CASE WHEN p_partkey%400=49 THEN 100 WHEN p_partkey%10 IN (0, 1) THEN 3 WHEN p_partkey%10=2 THEN 17 ELSE 4+p_partkey%7%5 END AS w0,
 CASE WHEN p_partkey%400=49 THEN 70 WHEN p_partkey%10=2 THEN 17 ELSE 4+p_partkey%4 END AS h0,
 CASE WHEN p_partkey%400=44 THEN 66 WHEN p_partkey%400=49 THEN 1 WHEN p_partkey%10 IN (0, 2) THEN 1 WHEN p_partkey%10 IN (1, 5) THEN 2 ELSE 1+p_partkey%3 END AS k
FROM part"""

#: Their pixels (id, kind, w, h, x, y, r, g, b, a).
SPRITES = f"""
SELECT id, kind, w, h, x, y,
 CASE kind WHEN 2 THEN x*15 WHEN 3 THEN 10 ELSE CASE WHEN hole THEN (CASE kind WHEN 4 THEN 0 ELSE 255 END) WHEN speck THEN 1 ELSE v*20 END END AS r,
 CASE kind WHEN 2 THEN y*15 WHEN 3 THEN 20 ELSE CASE WHEN hole THEN 0 WHEN speck THEN 2 ELSE 100 END END AS g,
 CASE kind WHEN 2 THEN id%256 WHEN 3 THEN 30 ELSE CASE WHEN hole THEN (CASE kind WHEN 4 THEN 0 ELSE 255 END) WHEN speck THEN 3 ELSE 255-v*20 END END AS b,
 CASE WHEN kind=4 AND hole THEN 0 ELSE 255 END AS a
FROM (SELECT *, (kind IN (4,6,7)) AND (x//k=0 OR y//k=0 OR x//k=w0-1 OR y//k=h0-1) AS hole, (kind=5 AND x=3 AND y=3) AS speck, (id*7+x//k*3+y//k*5)%11 AS v
 FROM (SELECT *, w0*k AS w, h0*k AS h, unnest(range(w0*k)) AS x FROM (SELECT *, unnest(range(h0*k)) AS y FROM ({SPRITE_SIZES}) s) t) u) q
"""

#: Which of eight files a derived sprite becomes; one with more than 256 colours can't have a palette.
SPRITE_FORMAT = "CAST(CASE WHEN kind = 2 AND CAST(FLOOR(id/10) AS INT)%8 IN (5, 6) THEN 4 ELSE CAST(FLOOR(id/10) AS INT)%8 END AS INT)"

#: Cells (w x h) of derived JPEG files, one for each part.
JPEG_SIZES = "SELECT p_partkey AS id, 1 + p_partkey % 5 AS w, 1 + p_partkey % 7 AS h FROM part"

def _answers(engine: str) -> str:
    """(conv_id, turn, answer): what models say, by conversation: an object, one in a fence, one with escapes, a broken one, a list, and one without the fields asked for."""
    quoted = "to_json(named_struct('description', text, 'is_animation', true, 'frames', turn))" if engine == "spark" else "CAST(json_object('description', text, 'is_animation', true, 'frames', turn) AS VARCHAR)"
    parts = (
        quoted,
        f"concat('Look: ```json ', {quoted}, ' ``` so ```json ', role, '```')",
        """concat('{"description": "the', chr(92), '_', role, '", "frames": "12"}')""",
        """concat('{"description": ', text)""",
        "concat('[1, \"', role, '\"]')",
        """'{"is_animation": "yes", "frames": 2.5}'""",
    )
    cases = " ".join(f"WHEN {k} THEN {part}" for k, part in enumerate(parts))
    return f"SELECT conv_id, turn, role, text, concat('USER: ', role, ' ASSISTANT: old ASSISTANT:  ', CASE conv_id % 6 {cases} END, ' ') AS answer FROM conversations"


CTES = {
    "hrefs": {
        "spark": f"SELECT page_id, pos, href FROM pages LATERAL VIEW posexplode(regexp_extract_all(html, '{LINK}', 1)) t AS pos, href",
        "duck": f"SELECT page_id, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS href FROM (SELECT page_id, regexp_extract_all(html, '{LINK}', 1) AS l FROM pages)",
    },
    "navs": {
        "spark": f"SELECT page_id, pos, href FROM pages LATERAL VIEW posexplode(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '{LINK}', 1)) t AS pos, href",
        "duck": f"SELECT page_id, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS href FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '{LINK}', 1) AS l FROM pages)",
    },
    "files": "SELECT page_id, url, regexp_extract(url, '([^/]*)$', 1) AS name FROM pages",
    "ids": "SELECT page_id, CAST(page_id AS STRING) AS n, CAST(page_id + 1 AS STRING) AS n1 FROM pages",
    # a gallery (listings lead to details, details to files) and a console's index (games, assets, media), some of each for every page
    "site": """SELECT concat('https://art.example/search?page=', n) AS url, CASE WHEN page_id % 10 = 3 THEN 503 ELSE 200 END AS status,
        concat('<a href="/content/c', n, '">x</a><a href="/content/c', n, '">again</a><a href="/content/c', n1, '">y</a><a href="/user/u', n, '">u</a>') AS html FROM ids
      UNION ALL SELECT concat('https://art.example/content/c', n), 200, concat('<span class="file"><a href="/f/hero', n, '.PNG">h</a></span><a href="/f/out', n,
        '.png">o</a><span class="file"><a href="/f/my_Avatar', n, '.png">a</a></span><span class="file"><a href="/f/pack', n, '.zip"></a></span><span class="file"><a href="/f/s', n,
        '.png?x=1"></a></span><span class="file"><a href="/f/doc', n, '.pdf"></a></span><span class="file"><a href=""></a></span>') FROM ids
      UNION ALL SELECT concat('https://res.example/snes/?part=', n), 200, concat('<a href="/snes/game', n, '/">g</a><a href="/snes/game', n, '/">g</a><a href="/snes/a/"></a><a href="/snes/game', n,
        '/extra/"></a><a href="/snes/game', n, '"></a><a href="/nes/game', n, '/"></a>') FROM ids
      UNION ALL SELECT concat('https://res.example/snes/game', n, '/'), 200, concat('<a href="/other/', n, '"></a><a href="/asset/', n, '">a</a><a href="/asset/', n, '/b">a</a>') FROM ids
      UNION ALL SELECT concat('https://res.example/asset/', n), 200, concat('<a href="/"></a><a href="/media/assets/', n, '/hero', n, '.png?updated=1">m</a><a href="/media/assets/', n, '/no.png">m</a>') FROM ids""",
    "site_links": f"SELECT url, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS href FROM (SELECT url, regexp_extract_all(html, '{LINK}', 1) AS l FROM site WHERE status = 200) q",
    "found": "SELECT DISTINCT concat('https://art.example', href) AS target FROM site_links WHERE url LIKE '%/search?page=%' AND regexp_matches(href, '^/content/')",
    "file_links": """SELECT url, concat('https://art.example', unnest(regexp_extract_all(html, '<span class="file"><a href="(/[^"]*)"', 1))) AS target FROM site WHERE status = 200""",
    "games": "SELECT url, pos, href FROM site_links WHERE url LIKE '%/snes/?part=%' AND regexp_matches(href, '^/snes/[^/][^/]+/$')",
    "sprites": SPRITES,
    "ahead": """SELECT s.*,
      lead(r) OVER (PARTITION BY id, y ORDER BY x) AS rx, lead(g) OVER (PARTITION BY id, y ORDER BY x) AS gx,
      lead(b) OVER (PARTITION BY id, y ORDER BY x) AS bx, lead(a) OVER (PARTITION BY id, y ORDER BY x) AS ax,
      lead(r) OVER (PARTITION BY id, x ORDER BY y) AS ry, lead(g) OVER (PARTITION BY id, x ORDER BY y) AS gy,
      lead(b) OVER (PARTITION BY id, x ORDER BY y) AS bz, lead(a) OVER (PARTITION BY id, x ORDER BY y) AS ay FROM sprites s""",
    "changes": """SELECT id, 'h' AS axis, y AS line, x AS spot FROM ahead WHERE r <> rx OR g <> gx OR b <> bx OR a <> ax
      UNION ALL SELECT id, 'v' AS axis, x AS line, y AS spot FROM ahead WHERE r <> ry OR g <> gy OR b <> bz OR a <> ay""",
    "runs": "SELECT id, axis, line, run FROM (SELECT id, axis, line, spot - lag(spot) OVER (PARTITION BY id, axis, line ORDER BY spot) AS run FROM changes) q WHERE run IS NOT NULL",
    "sizes": "SELECT id, max(kind) AS kind, max(w) AS w, max(h) AS h FROM sprites GROUP BY id",
    "run_set": "SELECT DISTINCT id, run FROM runs",
    "scales": "SELECT s.id, s.w, s.h, coalesce(d.scale, 1) AS scale FROM sizes s LEFT JOIN (SELECT id, list_reduce(list(run), lambda p, q: gcd(p, q)) AS scale FROM run_set GROUP BY id) d ON s.id = d.id",
    "natives": "SELECT id, w, h, scale, greatest(1, CAST(FLOOR(w / scale) AS BIGINT)) AS nw, greatest(1, CAST(FLOOR(h / scale) AS BIGINT)) AS nh FROM scales",
    "native_spots": "SELECT *, unnest(range(nw)) AS x FROM (SELECT *, unnest(range(nh)) AS y FROM natives) t",
    "reduced": """SELECT n.id, n.nw, n.nh, n.x, n.y, s.r, s.g, s.b, s.a FROM native_spots n
      JOIN sprites s ON s.id = n.id AND s.x = CAST(FLOOR((n.x + 0.5) * n.w / n.nw) AS BIGINT) AND s.y = CAST(FLOOR((n.y + 0.5) * n.h / n.nh) AS BIGINT)""",
    "square_spots": "SELECT *, unnest(range(64)) AS x FROM (SELECT *, unnest(range(64)) AS y FROM sizes) t",
    "squares": """SELECT n.id, n.x, n.y, s.r, s.g, s.b, s.a FROM square_spots n
      JOIN sprites s ON s.id = n.id AND s.x = CAST(FLOOR((n.x + 0.5) * n.w / 64) AS BIGINT) AND s.y = CAST(FLOOR((n.y + 0.5) * n.h / 64) AS BIGINT)""",
    "channels": "SELECT id, x, y, 0 AS channel, r AS v FROM squares UNION ALL SELECT id, x, y, 1, g FROM squares UNION ALL SELECT id, x, y, 2, b FROM squares UNION ALL SELECT id, x, y, 3, a FROM squares",
    "palettes": "SELECT id, count(*) AS palette_size FROM (SELECT DISTINCT id, r, g, b, a FROM reduced) q GROUP BY id",
    "corners": """SELECT id, min(r) AS r, min(g) AS g, min(b) AS b, min(a) AS a,
      (min(r) = max(r) AND min(g) = max(g) AND min(b) = max(b) AND min(a) = max(a) AND min(a) > 0) AS removed
      FROM reduced WHERE (x = 0 OR x = nw - 1) AND (y = 0 OR y = nh - 1) GROUP BY id""",
    "verdicts": """SELECT n.id, n.scale, n.nw, n.nh, p.palette_size, c.removed,
      CASE WHEN n.w < 4 OR n.h < 4 THEN 'too_small_native' WHEN n.nw < 4 OR n.nh < 4 THEN 'too_small_reduced'
           WHEN p.palette_size > 256 THEN 'too_many_colors' ELSE 'accepted' END AS verdict
      FROM natives n JOIN palettes p ON n.id = p.id JOIN corners c ON n.id = c.id""",
    "metadata": f"""SELECT id, license_type, CASE WHEN license_type IN ('public_domain', 'cc-by') THEN 'safe_hf' ELSE 'private_train' END AS dataset_bucket, '' AS description,
      nw AS width, nh AS height, NOT removed AS has_background, palette_size, false AS is_animation, 1 AS frames, CAST(NULL AS DOUBLE) AS fps, source_url
      FROM (SELECT *, {SPRITE_LICENSE} AS license_type, {SPRITE_URL} AS source_url FROM verdicts) q WHERE verdict = 'accepted'""",
    "dists": {
        "spark": """SELECT /*+ BROADCAST(c) */ v.vec_id, c.code, aggregate(zip_with(v.embedding, c.e, (p, q) -> (CAST(p AS DOUBLE) - CAST(q AS DOUBLE)) * (CAST(p AS DOUBLE) - CAST(q AS DOUBLE))), 0D, (s, t) -> s + t) AS d
          FROM embeddings v CROSS JOIN (SELECT vec_id AS code, embedding AS e FROM embeddings WHERE vec_id < 32) c""",
        "duck": """SELECT v.vec_id, c.code, list_sum(list_transform(list_zip(v.embedding, c.e), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE))) AS d
          FROM embeddings v CROSS JOIN (SELECT vec_id AS code, embedding AS e FROM embeddings WHERE vec_id < 32) c""",
    },
    "codes": {
        "spark": "SELECT vec_id, min_by(code, struct(round(d, 9), code)) AS code, min(d) AS d FROM dists GROUP BY vec_id",
        "duck": "SELECT vec_id, arg_min(code, {'d': round(d, 9), 'c': code}) AS code, min(d) AS d FROM dists GROUP BY vec_id",
    },
    "values_of": {
        "spark": "SELECT vec_id, pos, CAST(val AS DOUBLE) AS val FROM embeddings LATERAL VIEW posexplode(embedding) t AS pos, val",
        "duck": "SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS pos, CAST(unnest(embedding) AS DOUBLE) AS val FROM embeddings",
    },
    "betas": {
        "spark": "SELECT CAST(id AS INT) AS t, least(1 - pow(cos(((id + 1) / 1000D + 0.008D) / 1.008D * pi() / 2), 2) / pow(cos((id / 1000D + 0.008D) / 1.008D * pi() / 2), 2), 0.999D) AS beta FROM range(1000)",
        "duck": "SELECT CAST(i AS INTEGER) AS t, least(1 - pow(cos(((i + 1) / 1000.0::DOUBLE + 0.008::DOUBLE) / 1.008::DOUBLE * pi() / 2), 2) / pow(cos((i / 1000.0::DOUBLE + 0.008::DOUBLE) / 1.008::DOUBLE * pi() / 2), 2), 0.999::DOUBLE) AS beta FROM range(1000) x(i)",
    },
    "schedule": "SELECT t, exp(sum(ln(1 - beta)) OVER (ORDER BY t)) AS ab FROM betas",
    "answers": {engine: _answers(engine) for engine in ("spark", "duck")},
    "doc_sizes": {
        "spark": "SELECT doc_id AS id, lang AS bucket, CAST(octet_length(text) AS BIGINT) AS size FROM documents",
        "duck": "SELECT doc_id AS id, lang AS bucket, CAST(strlen(text) AS BIGINT) AS size FROM documents",
    },
}

#: name: the query's last SELECT, the same for both engines or one for each.
SELECTS = {
    "href_extract": "SELECT page_id, pos, href FROM hrefs",
    "css_descendant": "SELECT page_id, pos, href FROM navs",
    "urljoin_abs": "SELECT h.page_id, h.pos, concat(regexp_extract(p.url, '^([a-z]+://[^/?#]*)', 1), h.href) AS target FROM hrefs h JOIN pages p ON h.page_id = p.page_id WHERE h.href LIKE '/%'",
    "url_filename": "SELECT page_id, name FROM files",
    "url_strip_query": "SELECT page_id, concat('tsr_', regexp_extract(name, '^([^?]*)', 1)) AS name FROM files",
    "name_stem": "SELECT page_id, regexp_extract(name, '^([^.]*)', 1) AS stem FROM files",
    "name_template": "SELECT doc_id, concat('hf_', replace(concat(lang, '/', source), '/', '_'), '_', CASE WHEN doc_id < 1000000 THEN lpad(CAST(doc_id AS STRING), 6, '0') ELSE CAST(doc_id AS STRING) END, '.png') AS name FROM documents",
    "license_bucket": "SELECT doc_id, license_type, CASE WHEN license_type IN ('public_domain', 'cc-by') THEN 'safe_hf' ELSE 'private_train' END AS bucket FROM (SELECT doc_id, CASE source WHEN 'src0' THEN 'public_domain' WHEN 'src1' THEN 'cc-by' ELSE 'copyrighted_scrap' END AS license_type FROM documents) q",
    "byte_size": "SELECT id, size FROM doc_sizes",
    "latent_flatten": "SELECT vec_id, pos, CAST(FLOOR(pos / 16) AS BIGINT) AS channel, CAST(FLOOR(pos % 16 / 4) AS BIGINT) AS y, pos % 4 AS x, val FROM values_of",
    "ext_filter": "SELECT page_id, name FROM files WHERE name LIKE '%.html' OR name LIKE '%.png' OR name LIKE '%.gif' OR name LIKE '%.jpg' OR name LIKE '%.jpeg' OR name LIKE '%.webp'",
    "ext_filter_ci": "SELECT page_id, name FROM files WHERE lower(name) LIKE '%.html' OR lower(name) LIKE '%.png' OR lower(name) LIKE '%.gif' OR lower(name) LIKE '%.zip'",
    "link_dedup": "SELECT DISTINCT page_id, href FROM hrefs",
    "link_dedup_ordered": "SELECT page_id, href, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS k FROM (SELECT page_id, href, min(pos) AS pos FROM hrefs GROUP BY page_id, href) q",
    "link_slice": "SELECT page_id, href, k FROM (SELECT page_id, href, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS k FROM (SELECT page_id, href, min(pos) AS pos FROM hrefs GROUP BY page_id, href) q) s WHERE k > 1 AND k <= 3",
    "dataset_count": "SELECT (SELECT count(*) FROM documents) AS n_documents, (SELECT count(*) FROM pages) AS n_pages, (SELECT count(*) FROM embeddings) AS n_vectors",
    "batch_assign": "SELECT vec_id, CAST(FLOOR((row_number() OVER (ORDER BY vec_id) - 1) / 16) AS BIGINT) AS batch FROM embeddings",
    "mse": "SELECT round(avg((a.val - b.val) * (a.val - b.val)), 6) AS mse FROM values_of a JOIN codes c ON a.vec_id = c.vec_id JOIN values_of b ON b.vec_id = c.code AND b.pos = a.pos",
    "tensor_minmax": "SELECT min(val) AS least, max(val) AS most FROM values_of",
    "vq_distances": "SELECT vec_id, code, round(d, 6) AS d FROM dists",
}

#: A whole number from 0 to 16^12 - 1 that looks random, of a row's key and a salt: {0}.
MIXED = {"spark": "CAST(conv(substr(md5({0}), 1, 12), 16, 10) AS BIGINT)", "duck": "CAST(concat('0x', substr(md5({0}), 1, 12)) AS BIGINT)"}
NORMAL = "sqrt(-2 * ln(({0} + 1) / 281474976710657.0D)) * cos(2 * pi() * {1} / 281474976710656.0D)"


def _noised(engine: str) -> str:
    mixed = MIXED[engine].format
    key = "concat(vec_id, ':', pos, ':{0}')".format
    noise = NORMAL.format(mixed(key("u")), mixed(key("v")))
    step = mixed("concat(vec_id, ':t')")
    return f"SELECT vec_id, pos, CAST({step} % 1000 AS INT) AS t, val, {noise} AS eps FROM values_of"


CTES["noised"] = {engine: _noised(engine) for engine in MIXED}
SELECTS |= {
    "timestep_sample": {engine: f"SELECT vec_id, CAST({m.format("concat(vec_id, ':t')")} % 1000 AS INT) AS t FROM embeddings" for engine, m in MIXED.items()},
    "gaussian_noise": "SELECT vec_id, pos, round(eps, 6) AS eps FROM noised",
    "ddpm_add_noise": "SELECT n.vec_id, n.pos, n.t, round(sqrt(s.ab) * n.val + sqrt(1 - s.ab) * n.eps, 6) AS noisy FROM noised n JOIN schedule s ON s.t = n.t",
}

#: Oracles of the crawl, which Spark answers by its own operators over stored pages.
CRAWL_ORACLES = {
    "frontier": "SELECT concat(host, '/search?page=', unnest(range(n))) AS url FROM (SELECT regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS host, count(*) AS n FROM pages GROUP BY 1)",
    "anti_existing": "SELECT concat('art', doc_id, '.png') AS name, md5(text) AS digest FROM documents WHERE doc_id % 11 > 0 AND doc_id % 13 > 0 AND doc_id NOT IN (SELECT doc_id FROM labels)",
    "source_limit": "SELECT concat('hf_own_docs_', lpad(CAST(d.doc_id AS VARCHAR), 6, '0'), '.png') AS name, md5(text) AS digest, 'own/docs' AS source_url FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL ORDER BY d.doc_id LIMIT 50",
    "coalesce_cols": "SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN md5(text) WHEN doc_id % 5 > 0 THEN md5(source) END AS digest FROM documents",
    "first_image_column": "SELECT doc_id, md5(concat(lang, ':', source)) AS digest FROM documents",
    "http_ok": "SELECT url, CAST(length(html) AS INT) AS n FROM site WHERE status = 200 AND url LIKE '%/search?page=%'",
    "href_prefix": "SELECT url, pos, href FROM site_links WHERE url LIKE '%/search?page=%' AND regexp_matches(href, '^/content/')",
    "href_structural": "SELECT url, pos, href FROM games",
    "href_contains": "SELECT DISTINCT url, concat('https://res.example', href) AS target FROM site_links WHERE url LIKE '%/snes/game%' AND regexp_matches(href, '/asset/')",
    "href_first_match": "SELECT url, arg_min(href, pos) AS href FROM site_links WHERE url LIKE '%/asset/%' AND regexp_matches(href, '/media/assets/') GROUP BY url",
    "icon_reject": "SELECT target AS url, regexp_extract(target, '[^/]*$') AS name FROM file_links WHERE regexp_matches(target, '(?i)[.](png|gif|zip)$') AND NOT regexp_matches(target, '(?i)(avatar|icon)[^/]*$')",
    "crawl_level1": "SELECT target FROM found",
    "crawl_level2": "SELECT l.target AS url, regexp_extract(l.target, '[^/]*$') AS name FROM found f JOIN file_links l ON l.url = f.target WHERE regexp_matches(l.target, '(?i)[.](png|gif|zip)$')",
    "crawl_stream": """SELECT u.url, kind, CAST(coalesce(status, 404) AS INTEGER) AS status
      FROM (SELECT url, 'listing' AS kind FROM site WHERE url LIKE '%/search?page=%' UNION SELECT target, 'detail' FROM found
            UNION SELECT l.target, 'file' FROM found f JOIN file_links l ON l.url = f.target WHERE regexp_matches(l.target, '(?i)[.](png|gif|zip)$')) u LEFT JOIN site s ON s.url = u.url""",
    "crawl_console": """SELECT regexp_replace(concat('tsr_', regexp_extract(m.href, '[^/]*$')), '[?].*', '') AS name, concat('https://res.example', m.href) AS url
      FROM (SELECT href FROM (SELECT href, min(pos) AS pos FROM games GROUP BY href) q ORDER BY pos, href OFFSET 2 LIMIT 20) g
      JOIN (SELECT DISTINCT url, href FROM site_links WHERE regexp_matches(href, '/asset/')) a ON a.url = concat('https://res.example', g.href)
      JOIN (SELECT url, arg_min(href, pos) AS href FROM site_links WHERE regexp_matches(href, '/media/assets/') GROUP BY url) m ON m.url = concat('https://res.example', a.href)""",
}

#: Oracles of the queries over sprites, which Spark answers by its own operators over encoded images.
SPRITE_ORACLES = {
    "pixel_scale": "SELECT id, scale FROM scales",
    "clean_native_size": "SELECT id, nw, nh FROM natives",
    "size_gate": "SELECT id, w, h, (w < 4 OR h < 4) AS rejected FROM sizes",
    "palette_size": "SELECT id, palette_size FROM palettes",
    "palette_gate": "SELECT id, palette_size FROM palettes WHERE palette_size <= 256",
    "bg_detect": "SELECT id, removed FROM corners",
    "pixel_changes": "SELECT id, axis, line, spot FROM changes",
    "pixel_runs": "SELECT id, axis, run, count(*) AS n FROM runs GROUP BY id, axis, run",
    "rgb_project": "SELECT id, x, y, r, g, b FROM sprites",
    "norm_pm1": "SELECT id, x, y, round(r / 255.0D * 2 - 1, 6) AS r, round(g / 255.0D * 2 - 1, 6) AS g, round(b / 255.0D * 2 - 1, 6) AS b, round(a / 255.0D * 2 - 1, 6) AS a FROM sprites",
    "downscale_nearest": "SELECT id, x, y, r, g, b, a FROM reduced",
    "bg_mask": "SELECT d.id, d.x, d.y, CASE WHEN hit THEN 0 ELSE d.r END AS r, CASE WHEN hit THEN 0 ELSE d.g END AS g, CASE WHEN hit THEN 0 ELSE d.b END AS b, CASE WHEN hit THEN 0 ELSE d.a END AS a FROM (SELECT d.*, (c.removed AND d.r = c.r AND d.g = c.g AND d.b = c.b AND d.a = c.a) AS hit FROM reduced d JOIN corners c ON d.id = c.id) d",
    "resize_nearest": "SELECT id, y, md5(string_agg(concat_ws(',', r, g, b, a), ';' ORDER BY x)) AS pixels FROM squares GROUP BY id, y",
    "training_tensor": "SELECT id, channel, round(min(v) / 255.0D * 2 - 1, 5) AS least, round(max(v) / 255.0D * 2 - 1, 5) AS most, md5(string_agg(CAST(v AS STRING), ',' ORDER BY y, x)) AS pixels FROM channels GROUP BY id, channel",
    "clean_verdict": "SELECT id, scale, verdict FROM verdicts",
    "clean_accepted": "SELECT id, nw, nh FROM verdicts WHERE verdict = 'accepted'",
    "verdict_counts": "SELECT verdict, count(*) AS n FROM verdicts GROUP BY verdict",
    "clean_metadata": "SELECT * REPLACE (CAST(frames AS BIGINT) AS frames) FROM metadata",
    "image_decode": "SELECT v.id, v.verdict, v.removed AND v.verdict = 'accepted' AS bg_removed, coalesce(m.width, -1) AS width, coalesce(m.height, -1) AS height, coalesce(m.palette_size, -1) AS palette_size FROM verdicts v LEFT JOIN metadata m ON v.id = m.id",
    "metadata_json": """SELECT id, concat('{', chr(10), '  "license_type": "', license_type, '",', chr(10), '  "dataset_bucket": "', dataset_bucket, '",', chr(10), '  "description": "",', chr(10),
      '  "width": ', width, ',', chr(10), '  "height": ', height, ',', chr(10), '  "has_background": ', has_background, ',', chr(10), '  "palette_size": ', palette_size, ',', chr(10),
      '  "is_animation": false,', chr(10), '  "frames": 1,', chr(10), '  "fps": null,', chr(10), '  "source_url": "', source_url, '"', chr(10), '}') AS json FROM metadata""",
}


def _learning(rounds: int) -> str:
    """The loss before each round, in which a codeword goes half of the way to the mean of its vectors."""
    sql = """WITH x AS (SELECT vec_id, unnest(range(len(embedding))) AS pos, CAST(unnest(embedding) AS DOUBLE) AS val FROM embeddings),
b0 AS (SELECT vec_id AS code, pos, val FROM x WHERE vec_id < 32)"""
    for k in range(rounds):
        sql += f""",
d{k} AS (SELECT x.vec_id, b.code, sum((x.val - b.val) * (x.val - b.val)) AS d FROM x JOIN b{k} b USING (pos) GROUP BY x.vec_id, b.code),
n{k} AS (SELECT vec_id, arg_min(code, {{'d': round(d, 9), 'c': code}}) AS code, min(d) AS d FROM d{k} GROUP BY vec_id),
m{k} AS (SELECT n.code, x.pos, avg(x.val) AS val FROM n{k} n JOIN x USING (vec_id) GROUP BY n.code, x.pos),
b{k + 1} AS (SELECT b.code, b.pos, CASE WHEN m.val IS NULL THEN b.val ELSE 0.5 * b.val + 0.5 * m.val END AS val FROM b{k} b LEFT JOIN m{k} m ON m.code = b.code AND m.pos = b.pos)"""
    return sql + "\n" + " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS round, round(sum(d) / (count(*) * (SELECT count(DISTINCT pos) FROM x)), 6) AS loss FROM n{k}" for k in range(rounds))


#: Oracles of queries over answers, vectors, formats and shards, which Spark answers by the library.
LIBRARY_ORACLES = {
    "vlm_tail": "SELECT conv_id, turn, regexp_replace(regexp_replace(answer, '(?s)^.*ASSISTANT:', ''), '^[[:space:]]+|[[:space:]]+$', '', 'g') AS tail FROM answers",
    "vlm_fence": """SELECT conv_id, turn, CASE conv_id % 6 WHEN 0 THEN object WHEN 1 THEN concat(' ', object, ' ') WHEN 2 THEN concat('{"description": "the_', role, '", "frames": "12"}')
        WHEN 3 THEN regexp_replace(concat('{"description": ', text), '[[:space:]]+$', '') WHEN 4 THEN concat('[1, "', role, '"]') ELSE '{"is_animation": "yes", "frames": 2.5}' END AS body
      FROM (SELECT *, CAST(json_object('description', text, 'is_animation', true, 'frames', turn) AS VARCHAR) AS object FROM conversations)""",
    "vlm_parse": """SELECT conv_id, turn, CASE conv_id % 6 WHEN 0 THEN text WHEN 1 THEN text WHEN 2 THEN concat('the_', role) WHEN 3 THEN regexp_replace(concat('{"description": ', text), '[[:space:]]+$', '')
        WHEN 4 THEN concat('[1, "', role, '"]') ELSE 'No description' END AS description,
        CASE conv_id % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 5 THEN false END AS is_animation,
        CAST(CASE conv_id % 6 WHEN 0 THEN turn WHEN 1 THEN turn WHEN 2 THEN 12 WHEN 5 THEN 1 END AS INTEGER) AS frames FROM conversations""",
    "vq_assign": "SELECT vec_id, code FROM codes",
    "vq_quantize": "SELECT c.vec_id, c.code, v.pos, v.val FROM codes c JOIN values_of v ON v.vec_id = c.code",
    "vq_learn": _learning(4),
    "vq_loss": "SELECT round(1.25 * sum(d) / (64 * count(*)), 6) AS loss FROM codes",
    "image_formats": f"""SELECT v.id, CASE WHEN broken THEN 'unreadable' ELSE v.verdict END AS verdict, v.removed AND v.verdict = 'accepted' AND NOT broken AS bg_removed,
        CASE WHEN broken THEN -1 ELSE coalesce(m.width, -1) END AS width, CASE WHEN broken THEN -1 ELSE coalesce(m.height, -1) END AS height, CASE WHEN broken THEN -1 ELSE coalesce(m.palette_size, -1) END AS palette_size
      FROM verdicts v LEFT JOIN metadata m ON v.id = m.id JOIN (SELECT id, {SPRITE_FORMAT} = 7 AS broken FROM ({SPRITE_SIZES})) f ON f.id = v.id""",
    "jpeg_decode": f"""SELECT id, 8 * w AS width, 8 * h AS height, CAST(CASE WHEN w > 2 OR h > 2 THEN 8 ELSE 1 END AS BIGINT) AS scale, n AS palette_size, CAST(greys AS BIGINT) AS greys
      FROM (SELECT id, any_value(w) AS w, any_value(h) AS h, count(DISTINCT grey) AS n, sum((x + 1) * (y + 1) * grey) AS greys
            FROM (SELECT *, (id * 31 + x * 17 + y * 29) % 256 AS grey FROM (SELECT *, unnest(range(w)) AS x FROM (SELECT *, unnest(range(h)) AS y FROM ({JPEG_SIZES})))) GROUP BY id)""",
    "annotate": "SELECT id, concat('sprite of ', width, ' x ', height, ' pixels') AS description, false AS is_animation, CAST(1 AS BIGINT) AS frames FROM metadata",
    "webdataset_write": f"SELECT bucket, CAST(j.id AS VARCHAR) AS name, j.json, true AS has_image FROM ({SPRITE_ORACLES['metadata_json']}) j JOIN (SELECT id, dataset_bucket AS bucket FROM metadata) m ON m.id = j.id",
}
