"""Reading and writing: certificates, snapshots, acknowledgements, alerts, reports."""
