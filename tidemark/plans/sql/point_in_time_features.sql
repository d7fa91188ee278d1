-- One row per score request, from page events that occurred before the request and had arrived
-- by it. Tables by name: {sessions}, {score_requests}, {page_events}, {session_slices}.
--
-- event_at_us < s AND available_at_us <= s is the same as visible_at <= s with
-- visible_at = greatest(event_at_us + 1, available_at_us), so both times fold into one line of
-- time and the answer is a running total along it: no (request, event) pairs are formed.
-- session_slices cuts the time line of very large sessions into pieces; a session without a
-- row there is one piece.
WITH moments AS (
    SELECT
        session_id,
        greatest(event_at_us + 1, available_at_us) AS at,
        -1 - pmod(xxhash64(event_id), 65536) AS side,
        1L AS pages,
        0L AS categories,
        event_at_us AS seen_at,
        CAST(NULL AS STRING) AS score_id
    FROM {page_events}
    UNION ALL
    SELECT
        session_id,
        min(greatest(event_at_us + 1, available_at_us)),
        -1L,
        0L,
        1L,
        CAST(NULL AS BIGINT),
        CAST(NULL AS STRING)
    FROM {page_events}
    GROUP BY session_id, page_category
    UNION ALL
    SELECT
        session_id,
        score_at_us,
        1 + pmod(xxhash64(score_id), 65536),
        0L,
        0L,
        CAST(NULL AS BIGINT),
        score_id
    FROM {score_requests}
),
sliced AS (
    SELECT /*+ BROADCAST(s) */
        m.*,
        s.heads IS NOT NULL AS is_sliced,
        CASE
            WHEN s.heads IS NULL OR size(filter(s.heads, h -> h <= struct(m.at, m.side))) = 0
                THEN 0
            ELSE (size(filter(s.heads, h -> h <= struct(m.at, m.side))) - 1) * s.width
                + size(filter(
                    s.cuts[size(filter(s.heads, h -> h <= struct(m.at, m.side))) - 1],
                    c -> c <= struct(m.at, m.side)))
        END AS slice
    FROM moments m
    LEFT JOIN {session_slices} s ON s.session_id = m.session_id
),
carried AS (
    SELECT
        session_id AS carry_session,
        slice AS carry_slice,
        sum(pages) OVER earlier AS pages_before,
        sum(categories) OVER earlier AS categories_before,
        max(seen_at) OVER earlier AS seen_before
    FROM (
        SELECT session_id, slice, sum(pages) AS pages, sum(categories) AS categories,
               max(seen_at) AS seen_at
        FROM sliced
        WHERE is_sliced AND session_id IN (SELECT session_id FROM {session_slices})
        GROUP BY session_id, slice
    )
    WINDOW earlier AS (
        PARTITION BY session_id ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
    )
),
running AS (
    SELECT
        session_id,
        slice,
        at,
        score_id,
        sum(pages) OVER upto AS pages,
        sum(categories) OVER upto AS categories,
        max(seen_at) OVER upto AS seen_at
    FROM sliced
    WINDOW upto AS (
        PARTITION BY session_id, slice ORDER BY at, side
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
    )
),
history AS (
    SELECT
        r.score_id,
        r.session_id,
        r.at AS score_at_us,
        r.pages + coalesce(c.pages_before, 0) AS pages,
        r.categories + coalesce(c.categories_before, 0) AS categories,
        greatest(r.seen_at, c.seen_before) AS seen_at
    FROM running r
    LEFT JOIN carried c ON c.carry_session = r.session_id AND c.carry_slice = r.slice
    WHERE r.score_id IS NOT NULL
)
SELECT
    h.score_id,
    h.session_id,
    s.user_id,
    h.score_at_us,
    s.country,
    s.age,
    s.new_user,
    s.source,
    (h.score_at_us - s.session_start_at_us) div 1000000 AS seconds_since_session_start,
    h.pages AS pages_observed_at_score_time,
    h.categories AS unique_page_categories_observed,
    h.seen_at AS feature_max_event_at_us,
    (h.score_at_us - h.seen_at) div 1000000 AS seconds_since_last_page_view
FROM history h
JOIN {sessions} s ON s.session_id = h.session_id
