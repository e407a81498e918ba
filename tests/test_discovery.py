"""Discovery of a batch against events taken one after the other."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rollcall.operators import discovery, registry

EVENT = "event_id long, event_guid string, last_modified_utc string, body_name string, event_date string, event_time string, location string, agenda_pdf_url string, minutes_pdf_url string, insite_url string, video_path string, agenda_status_name string, minutes_status_name string, ord int"
ROOM = {"Council Chambers - City Hall": ["NYCC-PV-CH-CHA"], "Committee Room - City Hall": ["NYCC-PV-CH-COM"], "250 Broadway, 8th floor": ["NYCC-250-8-1", "NYCC-250-8-2", "NYCC-250-8-3"], "Zoom": [], None: []}


def test_plausible_recordings(spark):
    rows = [
        ("NYCC-PV-CH-CHA_250501-101500.mp4", "2025-05-01", "10:00 AM", "Council Chambers", True),
        ("NYCC-PV-CH-CHA_250501-123100.mp4", "2025-05-01", "10:00 AM", "Council Chambers", False),
        ("NYCC-PV-CH-COM_250501-101500.mp4", "2025-05-01", "10:00 AM", "Council Chambers", False),
        ("OTHER_250501-101500.mp4", "2025-05-01", "10:00 AM", "Zoom", True),
        ("NYCC-250-8-2_250501-123000", "2025-05-01", "10:00 AM", "250 BROADWAY", True),
        ("NYCC-250-8-2", "2025-05-01", "10:00 AM", None, False),
        (None, "2025-05-01", "10:00 AM", None, False),
        ("X_250501-101500", None, "10:00 AM", None, False),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, name string, date string, time string, place string, want boolean")
    got = df.select("i", "want", discovery.plausible(F.col("name"), F.col("date"), F.col("time"), F.col("place")).alias("got")).collect()
    assert [r.got for r in sorted(got)] == [r[-1] for r in rows]


def test_a_batch_of_events(spark):
    rng = random.Random(3)
    day = datetime(2025, 5, 1, 10)
    stamp = lambda room, at: f"{room}_{at:%y%m%d-%H%M%S}"
    table = []
    for i in range(60):
        room = rng.choice(["NYCC-PV-CH-CHA", "NYCC-PV-CH-COM", "NYCC-250-8-1", "NYCC-250-8-3", "ELSE"])
        table.append((f"m{i:02}", None, stamp(room, day + timedelta(minutes=rng.randrange(0, 3000)))))
    held = spark.createDataFrame(table, "meeting_key string, legistar_event_id long, viebit_filename string")
    held = held.select(*[F.col(c) if c in held.columns else F.lit(None).cast(registry.REGISTRY[c].dataType).alias(c) for c in registry.REGISTRY.names])
    events, details = [], []
    for i in range(50):
        place, at = rng.choice(list(ROOM)), day + timedelta(minutes=10 * rng.randrange(0, 300))
        video = rng.choice([None, None, None, "https://h/" + rng.choice(table)[2] + ".mp4?x=1"])
        events.append((i, None, None, rng.choice(["City Council", "Committee on Land Use", None]), f"{at:%Y-%m-%dT00:00:00}", f"{at:%-I:%M %p}", place, None, None, None, video, None, None, i))
        if rng.random() < 0.2:
            details.append((i, rng.choice(table)[2]))
    def fits(name, e):
        at, when = datetime.strptime(name.split("_")[1], "%y%m%d-%H%M%S"), datetime.strptime(e[4][:10] + " " + e[5], "%Y-%m-%d %I:%M %p")
        return abs((at - when).total_seconds()) <= 150 * 60 and (not ROOM[e[6]] or name.split("_")[0] in ROOM[e[6]])

    # recordings that events name themselves are theirs; the others go, in turn, to the first event that fits
    own, pages = {}, dict(details)
    for e in events:
        named = [n for n in (e[10].split("/")[-1].split(".mp4")[0] if e[10] else None, pages.get(e[0])) if n and fits(n, e)]
        if named:
            own[e[0]] = named[0]
    free, want = [n for _, _, n in table if n not in own.values()], dict(own)
    for e in events:
        if e[0] not in own and (hit := next((n for n in free if fits(n, e)), None)):
            free.remove(hit)
            want[e[0]] = hit
    got = discovery.discover(held, spark.createDataFrame(events, EVENT), spark.createDataFrame(details, "event_id long, filename string"), "2025-06-01T00:00:00Z").collect()
    by_file = {}
    for e, n in want.items():
        by_file.setdefault(n, e)  # a recording that several events name ends with the last of them
    assert {r.legistar_event_id for r in got if r.viebit_filename} >= {e for e, n in want.items() if list(want.values()).count(n) == 1}
    assert all(r.viebit_filename == want[r.legistar_event_id] for r in got if r.legistar_event_id in want and list(want.values()).count(want[r.legistar_event_id]) == 1)
    alone = [r for r in got if r.legistar_event_id is not None and r.viebit_filename is None]
    assert {r.legistar_event_id for r in alone} <= {e[0] for e in events} - {e for e, n in want.items() if list(want.values()).count(n) == 1}
    row = next(r for r in got if r.legistar_event_id == events[0][0])
    assert row.discover_status == "discovered" and row.meeting_slug.startswith(events[0][4][:10]) and row.fetch_status in (None, "pending")
    assert sum(n in want.values() for n in {r.viebit_filename for r in got}) == len(set(want.values()))


def test_first_free_against_the_choice_in_turn(spark):
    rng = random.Random(9)
    pairs = {(rng.randrange(60), rng.randrange(40)) for _ in range(300)}
    taken, want = set(), {}
    for e in sorted({e for e, _ in pairs}):
        if mine := sorted(c for x, c in pairs if x == e and c not in taken):
            want[e] = mine[0]
            taken.add(mine[0])
    frame = spark.createDataFrame(list(pairs), "event int, candidate int")
    assert {r.event: r.candidate for r in discovery.first_free(frame).collect()} == want
    assert discovery.first_free(frame.limit(0)).count() == 0
