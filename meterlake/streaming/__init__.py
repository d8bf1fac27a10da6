"""Structured Streaming: incremental ingest of landed CSV files and windowed health alerts."""
from .ingest import incremental_ingest
from .alerts import alert_windows, health_alerts_stream
from .outages import outage_spells_stream, spell_sessions
from .staged import accounting, dead_letters, stage_landed
from .versioned import merge_version, versioned_ingest

__all__ = ["incremental_ingest", "merge_version", "versioned_ingest", "alert_windows", "health_alerts_stream",
           "outage_spells_stream", "spell_sessions", "accounting", "dead_letters", "stage_landed"]
