"""File and table scans."""
