"""Raw-zone inputs: CSV scan, landing, inventory, notifications."""
