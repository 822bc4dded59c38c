"""The layers: staging, marts, quality, portfolio reports, serving relations, intake."""
