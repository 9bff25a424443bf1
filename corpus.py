"""Statement corpus derived from ``orders`` and the rows it must give.

Each order gives one statement: a template chosen by its key, with ``~``
replaced by a number. That number is the customer, so different texts grow with
the data, except for a third of the orders, which all use 0: those are copies
of few texts and touch a few hot tables. The queries' oracles read the expected rows from
here. For templates 31 to 43 they were derived by hand; for 0 to 30 the lists were drafted
with the job's own output and then read against the rules, so an error that the job and
the reader share would not show.
"""

from __future__ import annotations

# Statement templates and, below, their expected rows.
TEMPLATES = [
    "SELECT b.hull, q.depth_m FROM port.berth_~ b JOIN quay_~ q ON b.quay_no = q.quay_no LEFT JOIN port.crane_~ c"
    " ON c.quay_no = q.quay_no AND c.tons > 40 WHERE b.freed IS NULL ORDER BY q.depth_m DESC",
    "WITH seen AS (SELECT s.ship_no, s.eta FROM port.sighting_~ s), near AS (SELECT n.ship_no AS vessel, n.eta FROM seen n"
    " WHERE n.eta < 6), due AS (SELECT vessel, COUNT(*) AS calls FROM near GROUP BY vessel) SELECT d.vessel, d.calls,"
    " (SELECT MAX(f.fee) FROM fee_~ f WHERE f.ship_no = d.vessel) AS top_fee FROM due d",
    "SELECT v.imo, v.flag FROM (SELECT i.imo, i.flag FROM inbound_~ i INTERSECT SELECT c.imo, c.flag FROM cleared_~ c"
    " MINUS SELECT d.imo, 'NONE' AS flag FROM port.detained_~ d) v WHERE v.flag <> 'NONE'",
    'SELECT m.*, tide, "Moor Fee" FROM "Dues"."Moorage_~" m',
    "SELECT knots, zz.ballast FROM tug_~ t JOIN barge_~ g ON t.yard = g.yard",
    "SELECT draught FROM (SELECT t.beam, g.keel FROM tug_~ t JOIN barge_~ g ON t.yard = g.yard) h"
    " GROUP BY draught HAVING COUNT(*) > 1",
    "SELECT gust, wind, w.swell FROM (SELECT ~ AS wind) w",
    "SELECT e.skipper FROM (SELECT p.chief AS skipper FROM (SELECT r.boss AS chief, g.rig FROM roster_~ r JOIN rig_~ g"
    " ON r.rig_no = g.rig_no) p) e WHERE e.skipper NOT IN (SELECT x.boss FROM barred_~ x)",
    "SELECT y.rate FROM (SELECT * FROM tariff_~) y JOIN port.agent_~ a ON a.code = y.code"
    " WHERE y.rate BETWEEN 1 AND 9 AND a.home = 'HERE'",
    "SELECT COUNT(l.box) AS boxes, l.lane AS track, 7 AS seven FROM lading_~ l, port.gate_~ g WHERE l.gate = g.gate"
    " GROUP BY l.lane ORDER BY boxes, track, seven, lane",
    "SELECT * FROM (SELECT a.agent AS broker, h.port_no FROM deal_~ a JOIN haven_~ h ON a.port_no = h.port_no) d"
    " ORDER BY broker",
    "SELECT #SHIFT~# AS shift_no, w.#WATCH# FROM rota_#YEAR# w WHERE w.day_no = #SHIFT~#",
    "SELECT k.seal FROM crate_~ k, port.lot_~ o WHERE k.lot_no = o.lot_no AND EXISTS (SELECT 1 FROM hold_~ h JOIN hatch_~ t"
    " ON h.hatch = t.hatch WHERE h.seal = k.seal)",
    "SELECT f.nation, f.tonnage, f.age FROM (SELECT v.*, o.nation FROM (SELECT r.tonnage, s.imo FROM reg_~ r JOIN ship_~ s"
    " ON r.imo = s.imo) v JOIN owner_~ o ON v.imo = o.imo) f",
    "WITH raw AS (SELECT * FROM port.log_~), cut AS (SELECT * FROM raw WHERE kind = 'IN') SELECT c.stamp, o.code FROM cut c"
    " JOIN (SELECT p.code, p.stamp FROM pilot_~ p) o ON c.stamp = o.stamp",
    "WITH tank AS (SELECT * FROM port.fuel_~ u JOIN depot_~ e ON u.depot = e.depot) SELECT k.litres FROM tank k",
    "WITH load AS (SELECT CASE WHEN COUNT(*) > 9 THEN 'HEAVY' END AS grade, MAX(i.kg) AS top FROM item_~ i JOIN bale_~ z"
    " ON i.no = z.no), mark AS (SELECT load.grade AS g2, load.top + load.top AS twice FROM load)"
    " SELECT m.g2, m.twice FROM mark m",
    "SELECT z.sum_kg FROM (SELECT a.kg + a.kg AS sum_kg FROM item_~ a JOIN bale_~ b ON a.no = b.no UNION ALL"
    " SELECT c.kg FROM item_~ c) z",
    "WITH chain AS (SELECT l.link_no, 1 AS hops FROM tow_~ l WHERE l.head = 'Y' UNION ALL SELECT t.link_no, c.hops + 1 AS hops"
    " FROM tow_~ t JOIN chain c ON t.link_no = c.next_no) SELECT c.link_no, c.hops FROM chain c WHERE c.hops < 9",
    "WITH r (n, m) AS (SELECT a.i, a.j FROM hop_~ a UNION ALL SELECT r.n + 1, r.m FROM r) SELECT r.n, r.m FROM r",
    "WITH line AS (SELECT s.id, s.title AS trail FROM stop_~ s UNION ALL SELECT s.id, p.trail || s.title AS trail"
    " FROM stop_~ s JOIN line p ON s.up = p.id) SELECT p.trail FROM line p JOIN zone_~ z ON p.id = z.id",
    "SELECT knot, mast FROM (SELECT a.knot, x.w FROM sail_~ a JOIN spar_~ x ON a.no = x.no) p,"
    " (SELECT b.mast, b.knot FROM rigging_~ b) q",
    "SELECT draft FROM (SELECT a.beam FROM hull_~ a) p, (SELECT b.keel FROM hull_~ b) q"
    " WHERE EXISTS (SELECT 1 FROM dock_~ d WHERE d.state = 'N')",
    "WITH crew AS (SELECT p.nick, g.grade FROM person_~ p JOIN grade_~ g ON p.gr = g.gr) SELECT c.nick, c.shoe FROM crew c",
    "SELECT z.knots FROM /* fleet */ tug_~ t, /* more */ barge_~ g WHERE t.yard = g.yard",
    "SELECT t.lane, SUM(t.fee) OVER w AS so_far FROM toll_~ t WHERE t.paid = 'Y' GROUP BY t.lane, t.fee"
    " HAVING COUNT(t.ship) > 2 WINDOW w AS (PARTITION BY t.day_no) QUALIFY t.rank_no = 1 ORDER BY t.lane",
    "SELECT c.mark FROM crate_~ c WHERE c.mark = 'a;b' AND c.LOT = 4",
    "SELECT c.tag, ''' || 'A' || ''' AS grade FROM crate_~ c WHERE c.lot = 4'",
    "SELECT k.kind, #v_day#' FROM crate_~ k",
    "SELECT k.kind FROM crate_~ k WHERE k.LOT = 4, SELECT w.kind FROM waste_~ w WHERE 1 = 1';",
    "SELECT c.wage FROM crew_~ c WHERE c.paid = ' || v_dt || '' AND c.grade = 1",
    "SELECT c.name FROM (SELECT k.name FROM torn_~ k",
    "SELECT s.V_SUM, s.fee FROM stall_~@LNK s WHERE s.fee > 0 AND s.V_KIND = 1",
    "SELECT t.act, CURRENT_TIMESTAMP ts FROM hall.diary_~ t ORDER BY t.act_no NULLS LAST",
    "SELECT SUM(t.fee) OVER (PARTITION BY t.tier ORDER BY t.night ROWS BETWEEN UNBOUNDED PRECEDING"
    " AND CURRENT ROW) AS so_far FROM takings_~ t",
    "SELECT MAX(t.fee) KEEP (DENSE_RANK FIRST ORDER BY t.night) AS top_fee,"
    " CAST(t.opened AS TIMESTAMP WITH TIME ZONE) AS opened_at FROM takings_~ t",
    "SELECT CONNECT_BY_ROOT t.boss AS head FROM staff_~ t",
    "SELECT t.act, u.tint FROM\u00a0scene_~ t,\u00a0light_~\u00a0u",
    "(SELECT a.song FROM matinee_~ a ORDER BY a.place FETCH FIRST 3 ROWS ONLY)"
    " UNION ALL SELECT b.song FROM evening_~ b",
    "SELECT t.tier, COUNT(t.guest) AS n FROM arch.hall.visit_~ t GROUP BY t.tier HAVING MAX(t.fee) > 5",
    "SELECT FROM ghost_~ g WHERE g.night = 1",
    "SELECT g.night FROM WHERE g.night = ~",
    "SELECT g.night, g.act, FROM ghost_~ g",
    "SELECT g.night FROM ghost_~ g WHERE g.act = 1 AND",
]
#: texts that can be read only after the rewrites for dynamic SQL, as they read then
REWRITTEN = {
    27: "SELECT c.tag, 'A' AS grade FROM crate_~ c WHERE c.lot = 4",
    28: "SELECT k.kind, #v_day# FROM crate_~ k",
    29: "SELECT k.kind FROM crate_~ k WHERE k.LOT = 4",
    30: "SELECT c.wage FROM crew_~ c WHERE c.paid = #v_dt# AND c.grade = 1",
}
THREE_PARTS = 39
#: why a template cannot be read
REJECTED = {
    31: "unbalanced brackets", 40: "nothing selected", 41: "no source", 42: "dangling comma",
    43: "no condition",
}

# template | block | schema | table | column | reason | clause, in the order of the report; the second ON
# of a block is JOIN_ON:2
LINEAGE = """
0|1|PORT|BERTH_~|HULL||PROJECTION
0|1||QUAY_~|DEPTH_M||PROJECTION
0|1|PORT|BERTH_~|FREED||WHERE
0|1|PORT|BERTH_~|QUAY_NO||JOIN_ON
0|1||QUAY_~|QUAY_NO||JOIN_ON
0|1|PORT|CRANE_~|QUAY_NO||JOIN_ON:2
0|1||QUAY_~|QUAY_NO||JOIN_ON:2
0|1|PORT|CRANE_~|TONS||JOIN_ON:2
0|1||QUAY_~|DEPTH_M||ORDER_BY
1|1|PORT|SIGHTING_~|SHIP_NO||PROJECTION
1|1||DUAL|CALLS|DERIVED_COLUMN|PROJECTION
1|2||FEE_~|FEE||PROJECTION
1|2||FEE_~|SHIP_NO||WHERE
1|2||FEE_~|VESSEL||WHERE
1|3|PORT|SIGHTING_~|SHIP_NO||PROJECTION
1|3|PORT|SIGHTING_~|ETA||PROJECTION
1|4|PORT|SIGHTING_~|SHIP_NO||PROJECTION
1|4|PORT|SIGHTING_~|ETA||PROJECTION
1|4|PORT|SIGHTING_~|ETA||WHERE
1|5|PORT|SIGHTING_~|SHIP_NO||PROJECTION
1|5|PORT|SIGHTING_~|SHIP_NO||GROUP_BY
2|1||INBOUND_~|IMO||PROJECTION
2|1||CLEARED_~|IMO||PROJECTION
2|1|PORT|DETAINED_~|IMO||PROJECTION
2|1||INBOUND_~|FLAG||PROJECTION
2|1||CLEARED_~|FLAG||PROJECTION
2|1||INBOUND_~|FLAG||WHERE
2|1||CLEARED_~|FLAG||WHERE
2|2||INBOUND_~|IMO||PROJECTION
2|2||INBOUND_~|FLAG||PROJECTION
2|3||CLEARED_~|IMO||PROJECTION
2|3||CLEARED_~|FLAG||PROJECTION
2|4|PORT|DETAINED_~|IMO||PROJECTION
3|1|DUES|MOORAGE_~|TIDE||PROJECTION
3|1|DUES|MOORAGE_~|MOOR FEE||PROJECTION
4|1||TUG_~|KNOTS|FIRST_TABLE_FALLBACK|PROJECTION
4|1||TUG_~|BALLAST|TEXT_TABLE_FALLBACK|PROJECTION
4|1||TUG_~|YARD||JOIN_ON
4|1||BARGE_~|YARD||JOIN_ON
5|1||TUG_~|DRAUGHT|SUBQUERY_ANY_TABLE_FALLBACK|PROJECTION
5|1||TUG_~|DRAUGHT|SUBQUERY_ANY_TABLE_FALLBACK|GROUP_BY
5|2||TUG_~|BEAM||PROJECTION
5|2||BARGE_~|KEEL||PROJECTION
5|2||TUG_~|YARD||JOIN_ON
5|2||BARGE_~|YARD||JOIN_ON
6|1|||GUST|SUBQUERY_UNRESOLVED|PROJECTION
6|1||DUAL|WIND|DERIVED_COLUMN|PROJECTION
6|1||W|SWELL|SUBQUERY_ALIAS_FALLBACK|PROJECTION
7|1||ROSTER_~|BOSS||PROJECTION
7|1||ROSTER_~|BOSS||WHERE
7|2||ROSTER_~|BOSS||PROJECTION
7|4||BARRED_~|BOSS||PROJECTION
7|3||ROSTER_~|BOSS||PROJECTION
7|3||RIG_~|RIG||PROJECTION
7|3||ROSTER_~|RIG_NO||JOIN_ON
7|3||RIG_~|RIG_NO||JOIN_ON
8|1||TARIFF_~|RATE||PROJECTION
8|1||TARIFF_~|RATE||WHERE
8|1|PORT|AGENT_~|HOME||WHERE
8|1|PORT|AGENT_~|CODE||JOIN_ON
8|1||TARIFF_~|CODE||JOIN_ON
9|1||LADING_~|BOX||PROJECTION
9|1||LADING_~|LANE||PROJECTION
9|1||LADING_~|GATE||WHERE
9|1|PORT|GATE_~|GATE||WHERE
9|1||LADING_~|LANE||GROUP_BY
9|1||LADING_~|boxes||ORDER_BY
9|1||LADING_~|track||ORDER_BY
9|1||DUAL|SEVEN|DERIVED_COLUMN|ORDER_BY
9|1||LADING_~|LANE|TEXT_ALIAS_FALLBACK|ORDER_BY
10|1||DEAL_~|AGENT||ORDER_BY
10|2||DEAL_~|AGENT||PROJECTION
10|2||HAVEN_~|PORT_NO||PROJECTION
10|2||DEAL_~|PORT_NO||JOIN_ON
10|2||HAVEN_~|PORT_NO||JOIN_ON
11|1||DUAL|#SHIFT~#|PLACEHOLDER_COLUMN|PROJECTION
11|1||DUAL|#WATCH#|PLACEHOLDER_COLUMN|PROJECTION
11|1||ROTA_#YEAR#|DAY_NO||WHERE
11|1||DUAL|#SHIFT~#|PLACEHOLDER_COLUMN|WHERE
12|1||CRATE_~|SEAL||PROJECTION
12|1||CRATE_~|LOT_NO||WHERE
12|1|PORT|LOT_~|LOT_NO||WHERE
12|2||HOLD_~|SEAL||WHERE
12|2||CRATE_~|SEAL|TEXT_ALIAS_FALLBACK|WHERE
12|2||HOLD_~|HATCH||JOIN_ON
12|2||HATCH_~|HATCH||JOIN_ON
13|1||OWNER_~|NATION||PROJECTION
13|1||REG_~|TONNAGE||PROJECTION
13|1||OWNER_~|AGE||PROJECTION
13|2||OWNER_~|NATION||PROJECTION
13|2||SHIP_~|IMO||JOIN_ON
13|2||OWNER_~|IMO||JOIN_ON
13|3||REG_~|TONNAGE||PROJECTION
13|3||SHIP_~|IMO||PROJECTION
13|3||REG_~|IMO||JOIN_ON
13|3||SHIP_~|IMO||JOIN_ON
14|1|PORT|LOG_~|STAMP|CTE_SINGLE_TABLE_FALLBACK|PROJECTION
14|1||PILOT_~|CODE||PROJECTION
14|1|PORT|LOG_~|STAMP|CTE_SINGLE_TABLE_FALLBACK|JOIN_ON
14|1||PILOT_~|STAMP||JOIN_ON
14|2||PILOT_~|CODE||PROJECTION
14|2||PILOT_~|STAMP||PROJECTION
14|4|PORT|LOG_~|KIND||WHERE
15|1|PORT|FUEL_~|LITRES|SUBQUERY_STAR_FALLBACK|PROJECTION
15|2|PORT|FUEL_~|DEPOT||JOIN_ON
15|2||DEPOT_~|DEPOT||JOIN_ON
16|1||DUAL|GRADE|DERIVED_COLUMN|PROJECTION
16|1||ITEM_~|KG||PROJECTION
16|1||ITEM_~|KG||PROJECTION
16|2||ITEM_~|KG||PROJECTION
16|2||ITEM_~|NO||JOIN_ON
16|2||BALE_~|NO||JOIN_ON
16|3||DUAL|GRADE|DERIVED_COLUMN|PROJECTION
16|3||ITEM_~|KG||PROJECTION
16|3||ITEM_~|KG||PROJECTION
17|1||ITEM_~|KG||PROJECTION
17|2||ITEM_~|KG||PROJECTION
17|2||ITEM_~|KG||PROJECTION
17|2||ITEM_~|NO||JOIN_ON
17|2||BALE_~|NO||JOIN_ON
17|3||ITEM_~|KG||PROJECTION
18|1||TOW_~|LINK_NO||PROJECTION
18|1||DUAL|HOPS|DERIVED_COLUMN|PROJECTION
18|1||DUAL|HOPS|DERIVED_COLUMN|WHERE
18|2||TOW_~|LINK_NO||PROJECTION
18|2||TOW_~|HEAD||WHERE
18|3||TOW_~|LINK_NO||PROJECTION
18|3||DUAL|HOPS|DERIVED_COLUMN|PROJECTION
18|3||TOW_~|LINK_NO||JOIN_ON
18|3||TOW_~|NEXT_NO||JOIN_ON
19|1||HOP_~|N||PROJECTION
19|1||HOP_~|M||PROJECTION
19|2||HOP_~|I||PROJECTION
19|2||HOP_~|J||PROJECTION
19|3||HOP_~|N|CTE_ANY_TABLE_FALLBACK|PROJECTION
19|3||DUAL|M|DERIVED_COLUMN|PROJECTION
20|1||STOP_~|TITLE||PROJECTION
20|1||STOP_~|TRAIL||PROJECTION
20|1||STOP_~|ID||JOIN_ON
20|1||ZONE_~|ID||JOIN_ON
20|2||STOP_~|ID||PROJECTION
20|2||STOP_~|TITLE||PROJECTION
20|3||STOP_~|ID||PROJECTION
20|3||STOP_~|TRAIL||PROJECTION
20|3||STOP_~|TITLE||PROJECTION
20|3||STOP_~|TITLE||PROJECTION
20|3||STOP_~|UP||JOIN_ON
20|3||STOP_~|ID||JOIN_ON
21|1||SAIL_~|KNOT||PROJECTION
21|1||RIGGING_~|KNOT||PROJECTION
21|1||RIGGING_~|MAST||PROJECTION
21|2||SAIL_~|KNOT||PROJECTION
21|2||SPAR_~|W||PROJECTION
21|2||SAIL_~|NO||JOIN_ON
21|2||SPAR_~|NO||JOIN_ON
21|3||RIGGING_~|MAST||PROJECTION
21|3||RIGGING_~|KNOT||PROJECTION
22|1||HULL_~|DRAFT|SUBQUERY_SINGLE_TABLE_FALLBACK|PROJECTION
22|2||HULL_~|BEAM||PROJECTION
22|3||HULL_~|KEEL||PROJECTION
22|4||DOCK_~|STATE||WHERE
23|1||PERSON_~|NICK||PROJECTION
23|1||GRADE_~|SHOE|CTE_ANY_TABLE_FALLBACK|PROJECTION
23|1||PERSON_~|SHOE|CTE_ANY_TABLE_FALLBACK|PROJECTION
23|2||PERSON_~|NICK||PROJECTION
23|2||GRADE_~|GRADE||PROJECTION
23|2||PERSON_~|GR||JOIN_ON
23|2||GRADE_~|GR||JOIN_ON
24|1|||KNOTS|UNRESOLVED_TABLE|PROJECTION
24|1||TUG_~|YARD||WHERE
24|1||BARGE_~|YARD||WHERE
25|1||TOLL_~|LANE||PROJECTION
25|1||TOLL_~|FEE||PROJECTION
25|1||TOLL_~|PAID||WHERE
25|1||TOLL_~|SHIP||HAVING
25|1||TOLL_~|LANE||GROUP_BY
25|1||TOLL_~|FEE||GROUP_BY
25|1||TOLL_~|LANE||ORDER_BY
25|1||TOLL_~|DAY_NO||WINDOW
25|1||TOLL_~|RANK_NO||QUALIFY
26|1||CRATE_~|MARK||PROJECTION
26|1||CRATE_~|MARK||WHERE
26|1||CRATE_~|LOT||WHERE
27|1||CRATE_~|TAG||PROJECTION
27|1||CRATE_~|LOT||WHERE
28|1||CRATE_~|KIND||PROJECTION
28|1||DUAL|#V_DAY#|PLACEHOLDER_COLUMN|PROJECTION
29|1||CRATE_~|KIND||PROJECTION
29|1||CRATE_~|LOT||WHERE
30|1||CREW_~|WAGE||PROJECTION
30|1||CREW_~|PAID||WHERE
30|1||DUAL|#V_DT#|PLACEHOLDER_COLUMN|WHERE
30|1||CREW_~|GRADE||WHERE
32|1||STALL_~@LNK|V_SUM||PROJECTION
32|1||STALL_~@LNK|FEE||PROJECTION
32|1||STALL_~@LNK|FEE||WHERE
32|1||STALL_~@LNK|V_KIND||WHERE
33|1|HALL|DIARY_~|ACT||PROJECTION
33|1|HALL|DIARY_~|ACT_NO||ORDER_BY
34|1||TAKINGS_~|FEE||PROJECTION
34|1||TAKINGS_~|TIER||PROJECTION
34|1||TAKINGS_~|NIGHT||PROJECTION
35|1||TAKINGS_~|FEE||PROJECTION
35|1||TAKINGS_~|NIGHT||PROJECTION
35|1||TAKINGS_~|OPENED||PROJECTION
36|1||STAFF_~|BOSS||PROJECTION
37|1||SCENE_~|ACT||PROJECTION
37|1||LIGHT_~|TINT||PROJECTION
38|2||EVENING_~|SONG||PROJECTION
38|1||MATINEE_~|SONG||PROJECTION
38|1||MATINEE_~|PLACE||ORDER_BY
39|1|HALL|VISIT_~|TIER||PROJECTION
39|1|HALL|VISIT_~|GUEST||PROJECTION
39|1|HALL|VISIT_~|FEE||HAVING
39|1|HALL|VISIT_~|TIER||GROUP_BY
"""

# template | block | clause | its text
CLAUSES = """
0|1|PROJECTION|SELECT b.hull, q.depth_m
0|1|WHERE|WHERE b.freed IS NULL
0|1|JOIN_ON|ON b.quay_no = q.quay_no
0|1|JOIN_ON:2|ON c.quay_no = q.quay_no AND c.tons > 40
0|1|ORDER_BY|ORDER BY q.depth_m DESC
1|1|PROJECTION|SELECT d.vessel, d.calls, (SELECT MAX(f.fee) FROM fee_~ f WHERE f.ship_no = d.vessel) AS top_fee
1|2|PROJECTION|SELECT MAX(f.fee)
1|2|WHERE|WHERE f.ship_no = d.vessel
1|3|PROJECTION|SELECT s.ship_no, s.eta
1|4|PROJECTION|SELECT n.ship_no AS vessel, n.eta
1|4|WHERE|WHERE n.eta < 6
1|5|PROJECTION|SELECT vessel, COUNT(*) AS calls
1|5|GROUP_BY|GROUP BY vessel
2|1|PROJECTION|SELECT v.imo, v.flag
2|1|WHERE|WHERE v.flag <> 'NONE'
2|2|PROJECTION|SELECT i.imo, i.flag
2|3|PROJECTION|SELECT c.imo, c.flag
2|4|PROJECTION|SELECT d.imo, 'NONE' AS flag
3|1|PROJECTION|SELECT m.*, tide, "Moor Fee"
4|1|PROJECTION|SELECT knots, zz.ballast
4|1|JOIN_ON|ON t.yard = g.yard
5|1|PROJECTION|SELECT draught
5|1|GROUP_BY|GROUP BY draught
5|2|PROJECTION|SELECT t.beam, g.keel
5|2|JOIN_ON|ON t.yard = g.yard
6|1|PROJECTION|SELECT gust, wind, w.swell
7|1|PROJECTION|SELECT e.skipper
7|1|WHERE|WHERE e.skipper NOT IN (SELECT x.boss FROM barred_~ x)
7|2|PROJECTION|SELECT p.chief AS skipper
7|3|PROJECTION|SELECT r.boss AS chief, g.rig
7|3|JOIN_ON|ON r.rig_no = g.rig_no
7|4|PROJECTION|SELECT x.boss
8|1|PROJECTION|SELECT y.rate
8|1|WHERE|WHERE y.rate BETWEEN 1 AND 9 AND a.home = 'HERE'
8|1|JOIN_ON|ON a.code = y.code
9|1|PROJECTION|SELECT COUNT(l.box) AS boxes, l.lane AS track, 7 AS seven
9|1|WHERE|WHERE l.gate = g.gate
9|1|GROUP_BY|GROUP BY l.lane
9|1|ORDER_BY|ORDER BY boxes, track, seven, lane
10|1|ORDER_BY|ORDER BY broker
10|2|PROJECTION|SELECT a.agent AS broker, h.port_no
10|2|JOIN_ON|ON a.port_no = h.port_no
11|1|PROJECTION|SELECT #SHIFT~# AS shift_no, w.#WATCH#
11|1|WHERE|WHERE w.day_no = #SHIFT~#
12|1|PROJECTION|SELECT k.seal
12|1|WHERE|WHERE k.lot_no = o.lot_no AND EXISTS(SELECT 1 FROM hold_~ h JOIN hatch_~ t ON h.hatch = t.hatch WHERE h.seal = k.seal)
12|2|WHERE|WHERE h.seal = k.seal
12|2|JOIN_ON|ON h.hatch = t.hatch
13|1|PROJECTION|SELECT f.nation, f.tonnage, f.age
13|2|PROJECTION|SELECT v.*, o.nation
13|2|JOIN_ON|ON v.imo = o.imo
13|3|PROJECTION|SELECT r.tonnage, s.imo
13|3|JOIN_ON|ON r.imo = s.imo
14|1|PROJECTION|SELECT c.stamp, o.code
14|1|JOIN_ON|ON c.stamp = o.stamp
14|2|PROJECTION|SELECT p.code, p.stamp
14|4|WHERE|WHERE kind = 'IN'
15|1|PROJECTION|SELECT k.litres
15|2|JOIN_ON|ON u.depot = e.depot
16|1|PROJECTION|SELECT m.g2, m.twice
16|2|PROJECTION|SELECT CASE WHEN COUNT(*) > 9 THEN 'HEAVY' END AS grade, MAX(i.kg) AS top
16|2|JOIN_ON|ON i.no = z.no
16|3|PROJECTION|SELECT load.grade AS g2, load.top + load.top AS twice
17|1|PROJECTION|SELECT z.sum_kg
17|2|PROJECTION|SELECT a.kg + a.kg AS sum_kg
17|2|JOIN_ON|ON a.no = b.no
17|3|PROJECTION|SELECT c.kg
18|1|PROJECTION|SELECT c.link_no, c.hops
18|1|WHERE|WHERE c.hops < 9
18|2|PROJECTION|SELECT l.link_no, 1 AS hops
18|2|WHERE|WHERE l.head = 'Y'
18|3|PROJECTION|SELECT t.link_no, c.hops + 1 AS hops
18|3|JOIN_ON|ON t.link_no = c.next_no
19|1|PROJECTION|SELECT r.n, r.m
19|2|PROJECTION|SELECT a.i, a.j
19|3|PROJECTION|SELECT r.n + 1, r.m
20|1|PROJECTION|SELECT p.trail
20|1|JOIN_ON|ON p.id = z.id
20|2|PROJECTION|SELECT s.id, s.title AS trail
20|3|PROJECTION|SELECT s.id, p.trail || s.title AS trail
20|3|JOIN_ON|ON s.up = p.id
21|1|PROJECTION|SELECT knot, mast
21|2|PROJECTION|SELECT a.knot, x.w
21|2|JOIN_ON|ON a.no = x.no
21|3|PROJECTION|SELECT b.mast, b.knot
22|1|PROJECTION|SELECT draft
22|2|PROJECTION|SELECT a.beam
22|3|PROJECTION|SELECT b.keel
22|4|WHERE|WHERE d.state = 'N'
23|1|PROJECTION|SELECT c.nick, c.shoe
23|2|PROJECTION|SELECT p.nick, g.grade
23|2|JOIN_ON|ON p.gr = g.gr
24|1|PROJECTION|SELECT z.knots
24|1|WHERE|WHERE t.yard = g.yard
25|1|PROJECTION|SELECT t.lane, SUM(t.fee) OVER w AS so_far
25|1|WHERE|WHERE t.paid = 'Y'
25|1|HAVING|HAVING COUNT(t.ship) > 2
25|1|GROUP_BY|GROUP BY t.lane, t.fee
25|1|ORDER_BY|ORDER BY t.lane
25|1|WINDOW|WINDOW w AS (PARTITION BY t.day_no)
25|1|QUALIFY|QUALIFY t.rank_no = 1
26|1|PROJECTION|SELECT c.mark
26|1|WHERE|WHERE c.mark = 'a;b' AND c.LOT = 4
27|1|PROJECTION|SELECT c.tag, 'A' AS grade
27|1|WHERE|WHERE c.lot = 4
28|1|PROJECTION|SELECT k.kind, #v_day#
29|1|PROJECTION|SELECT k.kind
29|1|WHERE|WHERE k.LOT = 4
30|1|PROJECTION|SELECT c.wage
30|1|WHERE|WHERE c.paid = #v_dt# AND c.grade = 1
32|1|PROJECTION|SELECT s.V_SUM, s.fee
32|1|WHERE|WHERE s.fee > 0 AND s.V_KIND = 1
33|1|PROJECTION|SELECT t.act, CURRENT_TIMESTAMP ts
33|1|ORDER_BY|ORDER BY t.act_no NULLS LAST
34|1|PROJECTION|SELECT SUM(t.fee) OVER (PARTITION BY t.tier ORDER BY t.night ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
35|1|PROJECTION|SELECT MAX(t.fee) KEEP (DENSE_RANK FIRST ORDER BY t.night) AS top_fee, CAST(t.opened AS TIMESTAMP WITH TIME ZONE) AS opened_at
36|1|PROJECTION|SELECT CONNECT_BY_ROOT t.boss AS head
37|1|PROJECTION|SELECT t.act, u.tint
38|1|PROJECTION|SELECT a.song
38|1|ORDER_BY|ORDER BY a.place
38|2|PROJECTION|SELECT b.song
39|1|PROJECTION|SELECT t.tier, COUNT(t.guest) AS n
39|1|HAVING|HAVING MAX(t.fee) > 5
39|1|GROUP_BY|GROUP BY t.tier
"""

# template | block | schema | table | conditions of that table in that block, between them &&
CONDITIONS = """
0|1||QUAY_~|BERTH_~.quay_no = QUAY_~.quay_no && CRANE_~.quay_no = QUAY_~.quay_no
0|1|PORT|BERTH_~|BERTH_~.freed IS NULL && BERTH_~.quay_no = QUAY_~.quay_no
0|1|PORT|CRANE_~|CRANE_~.quay_no = QUAY_~.quay_no && CRANE_~.tons > 40
1|2||FEE_~|FEE_~.ship_no = d.vessel
1|4|PORT|SIGHTING_~|SIGHTING_~.eta < 6
2|1||CLEARED_~|INBOUND_~.flag <> 'NONE'
2|1||INBOUND_~|INBOUND_~.flag <> 'NONE'
4|1||BARGE_~|TUG_~.yard = BARGE_~.yard
4|1||TUG_~|TUG_~.yard = BARGE_~.yard
5|2||BARGE_~|TUG_~.yard = BARGE_~.yard
5|2||TUG_~|TUG_~.yard = BARGE_~.yard
7|1||ROSTER_~|ROSTER_~.skipper NOT IN (SELECT x.boss FROM barred_~ x)
7|3||RIG_~|ROSTER_~.rig_no = RIG_~.rig_no
7|3||ROSTER_~|ROSTER_~.rig_no = RIG_~.rig_no
8|1||TARIFF_~|TARIFF_~.rate BETWEEN 1 AND 9 && AGENT_~.code = TARIFF_~.code
8|1|PORT|AGENT_~|AGENT_~.home = 'HERE' && AGENT_~.code = TARIFF_~.code
9|1||LADING_~|LADING_~.gate = GATE_~.gate
9|1|PORT|GATE_~|LADING_~.gate = GATE_~.gate
10|2||DEAL_~|DEAL_~.port_no = HAVEN_~.port_no
10|2||HAVEN_~|DEAL_~.port_no = HAVEN_~.port_no
11|1||ROTA_#YEAR#|"ROTA_#YEAR#".day_no = #SHIFT~#
12|1||CRATE_~|CRATE_~.lot_no = LOT_~.lot_no && EXISTS(SELECT 1 FROM hold_~ h JOIN hatch_~ t ON h.hatch = t.hatch WHERE h.seal = CRATE_~.seal)
12|1|PORT|LOT_~|CRATE_~.lot_no = LOT_~.lot_no
12|2||HATCH_~|HOLD_~.hatch = HATCH_~.hatch
12|2||HOLD_~|HOLD_~.seal = k.seal && HOLD_~.hatch = HATCH_~.hatch
13|2||OWNER_~|SHIP_~.imo = OWNER_~.imo
13|2||SHIP_~|SHIP_~.imo = OWNER_~.imo
13|3||REG_~|REG_~.imo = SHIP_~.imo
13|3||SHIP_~|REG_~.imo = SHIP_~.imo
14|1||PILOT_~|LOG_~.stamp = PILOT_~.stamp
14|1|PORT|LOG_~|LOG_~.stamp = PILOT_~.stamp
15|2||DEPOT_~|FUEL_~.depot = DEPOT_~.depot
15|2|PORT|FUEL_~|FUEL_~.depot = DEPOT_~.depot
16|2||BALE_~|ITEM_~.no = BALE_~.no
16|2||ITEM_~|ITEM_~.no = BALE_~.no
17|2||BALE_~|ITEM_~.no = BALE_~.no
17|2||ITEM_~|ITEM_~.no = BALE_~.no
18|2||TOW_~|TOW_~.head = 'Y'
18|3||TOW_~|TOW_~.link_no = TOW_~.next_no
20|1||STOP_~|STOP_~.id = ZONE_~.id
20|1||ZONE_~|STOP_~.id = ZONE_~.id
20|3||STOP_~|STOP_~.up = STOP_~.id
21|2||SAIL_~|SAIL_~.no = SPAR_~.no
21|2||SPAR_~|SAIL_~.no = SPAR_~.no
22|4||DOCK_~|DOCK_~.state = 'N'
23|2||GRADE_~|PERSON_~.gr = GRADE_~.gr
23|2||PERSON_~|PERSON_~.gr = GRADE_~.gr
24|1||BARGE_~|TUG_~.yard = BARGE_~.yard
24|1||TUG_~|TUG_~.yard = BARGE_~.yard
25|1||TOLL_~|TOLL_~.paid = 'Y'
26|1||CRATE_~|CRATE_~.mark = 'a;b' AND CRATE_~.LOT = 4
27|1||CRATE_~|CRATE_~.lot = 4
29|1||CRATE_~|CRATE_~.LOT = 4
30|1||CREW_~|CREW_~.paid = #v_dt# && CREW_~.grade = 1
32|1||STALL_~@LNK|"STALL_~@LNK".fee > 0
"""

# template | block | parent | type | alias | level
BLOCKS = """
0|1||ROOT_SELECT||0
1|1||ROOT_SELECT||0
1|2|1|SUBQUERY|top_fee|1
1|3|1|CTE|seen|1
1|4|1|CTE|near|1
1|5|1|CTE|due|1
2|1||ROOT_SELECT||0
2|2|1|INTERSECT_LEFT||1
2|3|1|INTERSECT_RIGHT||1
2|4|1|EXCEPT_RIGHT||1
3|1||ROOT_SELECT||0
4|1||ROOT_SELECT||0
5|1||ROOT_SELECT||0
5|2|1|SUBQUERY|h|1
6|1||ROOT_SELECT||0
6|2|1|SUBQUERY|w|1
7|1||ROOT_SELECT||0
7|2|1|SUBQUERY|e|1
7|3|2|SUBQUERY|p|2
7|4|1|SUBQUERY||1
8|1||ROOT_SELECT||0
8|2|1|SUBQUERY|y|1
9|1||ROOT_SELECT||0
10|1||ROOT_SELECT||0
10|2|1|SUBQUERY|d|1
11|1||ROOT_SELECT||0
12|1||ROOT_SELECT||0
12|2|1|SELECT||1
13|1||ROOT_SELECT||0
13|2|1|SUBQUERY|f|1
13|3|2|SUBQUERY|v|2
14|1||ROOT_SELECT||0
14|2|1|SUBQUERY|o|1
14|3|1|CTE|raw|1
14|4|1|CTE|cut|1
15|1||ROOT_SELECT||0
15|2|1|CTE|tank|1
16|1||ROOT_SELECT||0
16|2|1|CTE|load|1
16|3|1|CTE|mark|1
17|1||ROOT_SELECT||0
17|2|1|UNION_LEFT||1
17|3|1|UNION_RIGHT||1
18|1||ROOT_SELECT||0
18|2|1|UNION_LEFT||1
18|3|1|UNION_RIGHT||1
19|1||ROOT_SELECT||0
19|2|1|UNION_LEFT||1
19|3|1|UNION_RIGHT||1
20|1||ROOT_SELECT||0
20|2|1|UNION_LEFT||1
20|3|1|UNION_RIGHT||1
21|1||ROOT_SELECT||0
21|2|1|SUBQUERY|p|1
21|3|1|SUBQUERY|q|1
22|1||ROOT_SELECT||0
22|2|1|SUBQUERY|p|1
22|3|1|SUBQUERY|q|1
22|4|1|SELECT||1
23|1||ROOT_SELECT||0
23|2|1|CTE|crew|1
24|1||ROOT_SELECT||0
25|1||ROOT_SELECT||0
26|1||ROOT_SELECT||0
27|1||ROOT_SELECT||0
28|1||ROOT_SELECT||0
29|1||ROOT_SELECT||0
30|1||ROOT_SELECT||0
32|1||ROOT_SELECT||0
33|1||ROOT_SELECT||0
34|1||ROOT_SELECT||0
35|1||ROOT_SELECT||0
36|1||ROOT_SELECT||0
37|1||ROOT_SELECT||0
38|1||UNION_LEFT||1
38|2||UNION_RIGHT||0
39|1||ROOT_SELECT||0
"""

# template | block | name | schema | alias | type
SOURCES = """
0|1|berth_~|port|b|PHYSICAL_TABLE
0|1|quay_~||q|PHYSICAL_TABLE
0|1|crane_~|port|c|PHYSICAL_TABLE
1|1|due||d|CTE
1|2|fee_~||f|PHYSICAL_TABLE
1|3|sighting_~|port|s|PHYSICAL_TABLE
1|4|seen||n|CTE
1|5|near||near|CTE
2|1|||v|SUBQUERY
2|2|inbound_~||i|PHYSICAL_TABLE
2|3|cleared_~||c|PHYSICAL_TABLE
2|4|detained_~|port|d|PHYSICAL_TABLE
3|1|Moorage_~|Dues|m|PHYSICAL_TABLE
4|1|tug_~||t|PHYSICAL_TABLE
4|1|barge_~||g|PHYSICAL_TABLE
5|1|||h|SUBQUERY
5|2|tug_~||t|PHYSICAL_TABLE
5|2|barge_~||g|PHYSICAL_TABLE
6|1|||w|SUBQUERY
7|1|||e|SUBQUERY
7|2|||p|SUBQUERY
7|3|roster_~||r|PHYSICAL_TABLE
7|3|rig_~||g|PHYSICAL_TABLE
7|4|barred_~||x|PHYSICAL_TABLE
8|1|||y|SUBQUERY
8|1|agent_~|port|a|PHYSICAL_TABLE
8|2|tariff_~||tariff_~|PHYSICAL_TABLE
9|1|lading_~||l|PHYSICAL_TABLE
9|1|gate_~|port|g|PHYSICAL_TABLE
10|1|||d|SUBQUERY
10|2|deal_~||a|PHYSICAL_TABLE
10|2|haven_~||h|PHYSICAL_TABLE
11|1|rota_#YEAR#||w|PHYSICAL_TABLE
12|1|crate_~||k|PHYSICAL_TABLE
12|1|lot_~|port|o|PHYSICAL_TABLE
12|2|hold_~||h|PHYSICAL_TABLE
12|2|hatch_~||t|PHYSICAL_TABLE
13|1|||f|SUBQUERY
13|2|||v|SUBQUERY
13|2|owner_~||o|PHYSICAL_TABLE
13|3|reg_~||r|PHYSICAL_TABLE
13|3|ship_~||s|PHYSICAL_TABLE
14|1|cut||c|CTE
14|1|||o|SUBQUERY
14|2|pilot_~||p|PHYSICAL_TABLE
14|3|log_~|port|log_~|PHYSICAL_TABLE
14|4|raw||raw|CTE
15|1|tank||k|CTE
15|2|fuel_~|port|u|PHYSICAL_TABLE
15|2|depot_~||e|PHYSICAL_TABLE
16|1|mark||m|CTE
16|2|item_~||i|PHYSICAL_TABLE
16|2|bale_~||z|PHYSICAL_TABLE
16|3|load||load|CTE
17|1|||z|SUBQUERY
17|2|item_~||a|PHYSICAL_TABLE
17|2|bale_~||b|PHYSICAL_TABLE
17|3|item_~||c|PHYSICAL_TABLE
18|1|chain||c|CTE
18|2|tow_~||l|PHYSICAL_TABLE
18|3|tow_~||t|PHYSICAL_TABLE
18|3|chain||c|CTE
19|1|r||r|CTE
19|2|hop_~||a|PHYSICAL_TABLE
19|3|r||r|CTE
20|1|line||p|CTE
20|1|zone_~||z|PHYSICAL_TABLE
20|2|stop_~||s|PHYSICAL_TABLE
20|3|stop_~||s|PHYSICAL_TABLE
20|3|line||p|CTE
21|1|||p|SUBQUERY
21|1|||q|SUBQUERY
21|2|sail_~||a|PHYSICAL_TABLE
21|2|spar_~||x|PHYSICAL_TABLE
21|3|rigging_~||b|PHYSICAL_TABLE
22|1|||p|SUBQUERY
22|1|||q|SUBQUERY
22|2|hull_~||a|PHYSICAL_TABLE
22|3|hull_~||b|PHYSICAL_TABLE
22|4|dock_~||d|PHYSICAL_TABLE
23|1|crew||c|CTE
23|2|person_~||p|PHYSICAL_TABLE
23|2|grade_~||g|PHYSICAL_TABLE
24|1|tug_~||t|PHYSICAL_TABLE
24|1|barge_~||g|PHYSICAL_TABLE
25|1|toll_~||t|PHYSICAL_TABLE
26|1|crate_~||c|PHYSICAL_TABLE
27|1|crate_~||c|PHYSICAL_TABLE
28|1|crate_~||k|PHYSICAL_TABLE
29|1|crate_~||k|PHYSICAL_TABLE
30|1|crew_~||c|PHYSICAL_TABLE
32|1|stall_~@LNK||s|PHYSICAL_TABLE
33|1|diary_~|hall|t|PHYSICAL_TABLE
34|1|takings_~||t|PHYSICAL_TABLE
35|1|takings_~||t|PHYSICAL_TABLE
36|1|staff_~||t|PHYSICAL_TABLE
37|1|scene_~||t|PHYSICAL_TABLE
37|1|light_~||u|PHYSICAL_TABLE
38|1|matinee_~||a|PHYSICAL_TABLE
38|2|evening_~||b|PHYSICAL_TABLE
39|1|visit_~|hall|t|PHYSICAL_TABLE
"""

# template | outputs | tables | schemas | conditions
LISTS = """
0|hull, depth_m|port.berth_~, quay_~, port.crane_~|port|b.freed IS NULL
1|vessel, calls, top_fee, MAX(f.fee), ship_no, eta|due, port.sighting_~, seen, near, fee_~|port|f.ship_no = d.vessel / n.eta < 6
2|imo, flag|inbound_~, cleared_~, port.detained_~|port|v.flag <> 'NONE'
3|m.*, tide, Moor Fee|Dues.Moorage_~|Dues|
4|knots, ballast|tug_~, barge_~||
5|draught, beam, keel|tug_~, barge_~||
6|gust, wind, swell|||
7|skipper, boss, chief, rig|barred_~, roster_~, rig_~||e.skipper NOT IN (SELECT x.boss FROM barred_~ x)
8|rate, *|port.agent_~, tariff_~|port|y.rate BETWEEN 1 AND 9 AND a.home = 'HERE'
9|boxes, track, seven|lading_~, port.gate_~|port|l.gate = g.gate
10|*, broker, port_no|deal_~, haven_~||
11|shift_no, #WATCH#|rota_#YEAR#||w.day_no = #SHIFT~#
12|seal, 1|crate_~, port.lot_~, hold_~, hatch_~|port|k.lot_no = o.lot_no AND EXISTS(SELECT 1 FROM hold_~ h JOIN hatch_~ t ON h.hatch = t.hatch WHERE h.seal = k.seal) / h.seal = k.seal
13|nation, tonnage, age, v.*, imo|owner_~, reg_~, ship_~||
14|stamp, code, *|cut, port.log_~, raw, pilot_~|port|kind = 'IN'
15|litres, *|tank, port.fuel_~, depot_~|port|
16|g2, twice, grade, top|mark, item_~, bale_~, load||
17|sum_kg, kg|item_~, bale_~||
18|link_no, hops|chain, tow_~||c.hops < 9 / l.head = 'Y'
19|n, m, i, j, r.n + 1|r, hop_~||
20|trail, id|line, zone_~, stop_~||
21|knot, mast, w|sail_~, spar_~, rigging_~||
22|draft, beam, keel, 1|hull_~, dock_~||EXISTS(SELECT 1 FROM dock_~ d WHERE d.state = 'N') / d.state = 'N'
23|nick, shoe, grade|crew, person_~, grade_~||
24|knots|tug_~, barge_~||t.yard = g.yard
25|lane, so_far|toll_~||t.paid = 'Y'
26|mark|crate_~||c.mark = 'a;b' AND c.LOT = 4
27|tag, grade|crate_~||c.lot = 4
28|kind, #v_day#|crate_~||
29|kind|crate_~||k.LOT = 4
30|wage|crew_~||c.paid = #v_dt# AND c.grade = 1
32|V_SUM, fee|stall_~@LNK||s.fee > 0 AND s.V_KIND = 1
33|act, ts|hall.diary_~|hall|
34|so_far|takings_~||
35|top_fee, opened_at|takings_~||
36|head|staff_~||
37|act, tint|scene_~, light_~||
38|song|evening_~, matinee_~||
39|tier, n|hall.visit_~|hall|
"""

# template | block | output | schema | table | column | reason
TRACES = """
0|1|depth_m||QUAY_~|DEPTH_M|
0|1|hull|PORT|BERTH_~|HULL|
1|1|calls||DUAL|CALLS|DERIVED_COLUMN
1|1|vessel|PORT|SIGHTING_~|SHIP_NO|
1|3|eta|PORT|SIGHTING_~|ETA|
1|3|ship_no|PORT|SIGHTING_~|SHIP_NO|
1|4|eta|PORT|SIGHTING_~|ETA|
1|4|vessel|PORT|SIGHTING_~|SHIP_NO|
1|5|vessel|PORT|SIGHTING_~|SHIP_NO|
2|1|flag||CLEARED_~|FLAG|
2|1|flag||INBOUND_~|FLAG|
2|1|imo||CLEARED_~|IMO|
2|1|imo|PORT|DETAINED_~|IMO|
2|1|imo||INBOUND_~|IMO|
2|2|flag||INBOUND_~|FLAG|
2|2|imo||INBOUND_~|IMO|
2|3|flag||CLEARED_~|FLAG|
2|3|imo||CLEARED_~|IMO|
2|4|imo|PORT|DETAINED_~|IMO|
3|1|moor fee|DUES|MOORAGE_~|MOOR FEE|
3|1|tide|DUES|MOORAGE_~|TIDE|
4|1|ballast|||BALLAST|UNRESOLVED_TABLE
4|1|knots||TUG_~|KNOTS|FIRST_TABLE_FALLBACK
5|1|draught||TUG_~|DRAUGHT|SUBQUERY_ANY_TABLE_FALLBACK
5|2|beam||TUG_~|BEAM|
5|2|keel||BARGE_~|KEEL|
6|1|gust|||GUST|SUBQUERY_UNRESOLVED
6|1|swell||W|SWELL|SUBQUERY_ALIAS_FALLBACK
6|1|wind||DUAL|WIND|DERIVED_COLUMN
7|1|skipper||ROSTER_~|BOSS|
7|2|skipper||ROSTER_~|BOSS|
7|3|chief||ROSTER_~|BOSS|
7|3|rig||RIG_~|RIG|
7|4|boss||BARRED_~|BOSS|
8|1|rate||TARIFF_~|RATE|
9|1|boxes||LADING_~|BOX|
9|1|track||LADING_~|LANE|
10|2|broker||DEAL_~|AGENT|
10|2|port_no||HAVEN_~|PORT_NO|
11|1|#watch#||DUAL|#WATCH#|PLACEHOLDER_COLUMN
11|1|shift_no||DUAL|#SHIFT~#|PLACEHOLDER_COLUMN
12|1|seal||CRATE_~|SEAL|
13|1|age||OWNER_~|AGE|
13|1|nation||OWNER_~|NATION|
13|1|tonnage||REG_~|TONNAGE|
13|2|nation||OWNER_~|NATION|
13|3|imo||SHIP_~|IMO|
13|3|tonnage||REG_~|TONNAGE|
14|1|code||PILOT_~|CODE|
14|1|stamp|PORT|LOG_~|STAMP|CTE_SINGLE_TABLE_FALLBACK
14|2|code||PILOT_~|CODE|
14|2|stamp||PILOT_~|STAMP|
15|1|litres|PORT|FUEL_~|LITRES|SUBQUERY_STAR_FALLBACK
16|1|g2||DUAL|GRADE|DERIVED_COLUMN
16|1|twice||ITEM_~|KG|
16|1|twice||ITEM_~|KG|
16|2|top||ITEM_~|KG|
16|3|g2||DUAL|GRADE|DERIVED_COLUMN
16|3|twice||ITEM_~|KG|
16|3|twice||ITEM_~|KG|
17|1|sum_kg||ITEM_~|KG|
17|2|sum_kg||ITEM_~|KG|
17|2|sum_kg||ITEM_~|KG|
17|3|kg||ITEM_~|KG|
18|1|hops||DUAL|HOPS|DERIVED_COLUMN
18|1|link_no||TOW_~|LINK_NO|
18|2|link_no||TOW_~|LINK_NO|
18|3|hops||DUAL|HOPS|DERIVED_COLUMN
18|3|link_no||TOW_~|LINK_NO|
19|1|m||HOP_~|M|
19|1|n||HOP_~|N|
19|2|i||HOP_~|I|
19|2|j||HOP_~|J|
19|3|m||DUAL|M|DERIVED_COLUMN
20|1|trail||STOP_~|TITLE|
20|1|trail||STOP_~|TRAIL|
20|2|id||STOP_~|ID|
20|2|trail||STOP_~|TITLE|
20|3|id||STOP_~|ID|
20|3|trail||STOP_~|TITLE|
20|3|trail||STOP_~|TITLE|
20|3|trail||STOP_~|TRAIL|
21|1|knot||RIGGING_~|KNOT|
21|1|knot||SAIL_~|KNOT|
21|1|mast||RIGGING_~|MAST|
21|2|knot||SAIL_~|KNOT|
21|2|w||SPAR_~|W|
21|3|knot||RIGGING_~|KNOT|
21|3|mast||RIGGING_~|MAST|
22|1|draft||HULL_~|DRAFT|SUBQUERY_SINGLE_TABLE_FALLBACK
22|2|beam||HULL_~|BEAM|
22|3|keel||HULL_~|KEEL|
23|1|nick||PERSON_~|NICK|
23|1|shoe||GRADE_~|SHOE|CTE_ANY_TABLE_FALLBACK
23|1|shoe||PERSON_~|SHOE|CTE_ANY_TABLE_FALLBACK
23|2|grade||GRADE_~|GRADE|
23|2|nick||PERSON_~|NICK|
24|1|knots|||KNOTS|UNRESOLVED_TABLE
25|1|lane||TOLL_~|LANE|
25|1|so_far||TOLL_~|FEE|
26|1|mark||CRATE_~|MARK|
27|1|tag||CRATE_~|TAG|
28|1|#v_day#||DUAL|#V_DAY#|PLACEHOLDER_COLUMN
28|1|kind||CRATE_~|KIND|
29|1|kind||CRATE_~|KIND|
30|1|wage||CREW_~|WAGE|
32|1|fee||STALL_~@LNK|FEE|
32|1|v_sum||STALL_~@LNK|V_SUM|
33|1|act|HALL|DIARY_~|ACT|
34|1|so_far||TAKINGS_~|FEE|
34|1|so_far||TAKINGS_~|NIGHT|
34|1|so_far||TAKINGS_~|TIER|
35|1|opened_at||TAKINGS_~|OPENED|
35|1|top_fee||TAKINGS_~|FEE|
35|1|top_fee||TAKINGS_~|NIGHT|
36|1|head||STAFF_~|BOSS|
37|1|act||SCENE_~|ACT|
37|1|tint||LIGHT_~|TINT|
38|1|song||MATINEE_~|SONG|
38|2|song||EVENING_~|SONG|
39|1|n|HALL|VISIT_~|GUEST|
39|1|tier|HALL|VISIT_~|TIER|
"""


def rows_of(block: str, width: int = 0) -> list[list[str]]:
    """Cells of a list; with a width the last cell keeps any ``|`` it holds."""
    return [line.split("|", width - 1) for line in block.strip().split("\n")]


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(block: str, columns: list[str]) -> str:
    """A VALUES relation; the first column is a number, ``nth`` the place in the list."""
    rows = [
        "(" + ", ".join([r[0], *[quoted(x) for x in r[1:]], str(i)]) + ")"
        for i, r in enumerate(rows_of(block, len(columns)))
    ]
    return f"(VALUES {', '.join(rows)}) v({', '.join(columns)}, nth)"


# The same text runs on Spark and on DuckDB.
STATEMENTS = f"""
SELECT o_orderkey AS stmt_id, o_orderkey % {len(TEMPLATES)} AS tpl,
       CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE CAST(o_custkey AS STRING) END AS k,
       concat('JOB_', CAST(o_custkey % 10 AS STRING)) AS JOB_NAME,
       CASE o_custkey % 7 WHEN 0 THEN 'Table' WHEN 1 THEN 'select' ELSE 'Select' END AS READ_MODE,
       replace(t.sql, '~', CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE CAST(o_custkey AS STRING) END)
         AS SELECT_STATEMENT
FROM orders JOIN (VALUES {", ".join(f"({i}, {quoted(s)})" for i, s in enumerate(TEMPLATES))})
     t(id, sql) ON o_orderkey % {len(TEMPLATES)} = t.id
"""
