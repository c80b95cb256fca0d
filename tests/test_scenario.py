"""The reference's own scenario on generated tables of its shape (S13): at-risk machines get
an open high-priority ticket, the ticket count is unchanged, and those tickets top the queue."""

from pyspark.sql import functions as F

from keyloop.plans import queues as Q
from keyloop.sources.seed import seed_tables

ACTIONS = ("action_id long, ticket_id long, performed_at timestamp, performed_by string, "
           "status string")


def test_at_risk_tickets_top_the_queue(spark):
    t = seed_tables(spark, scale=1.0, seed=42)
    readings = t["sensor_readings"]
    risky = Q.at_risk_machines(readings, {"vibration_mm_s": 6.0, "temperature_c": 80}, k=4)
    rows = risky.orderBy("pos").collect()
    assert [r.pos for r in rows] == [1, 2, 3, 4]
    # each is a machine whose reading crossed both bounds, in order of first crossing
    firsts = (readings.filter((F.col("vibration_mm_s") > 6.0) & (F.col("temperature_c") > 80))
              .groupBy("machine_id").agg(F.min("reading_id").alias("f")).orderBy("f", "machine_id")
              .limit(4).collect())
    assert [r.machine_id for r in rows] == [r.machine_id for r in firsts]

    tickets = Q.open_risk_tickets(t["maintenance_tickets"], risky, k=4)
    assert tickets.count() == 120
    flagged = tickets.filter(F.col("ticket_id") <= 4).orderBy("ticket_id").collect()
    assert [r.machine_id for r in flagged] == [r.machine_id for r in rows]
    assert all(r.priority == "high" and r.status == "open" for r in flagged)

    actions = spark.createDataFrame([], ACTIONS)
    queue = Q.open_alerts(tickets, t["machines"], actions, sort="priority", tie=["action_id"])
    top = [r.ticket_id for r in queue.limit(4).collect()]
    assert top == [1, 2, 3, 4]
