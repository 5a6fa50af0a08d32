"""Writers: commit-log commits, catalog-table writes, MERGE INTO, labels, file-system metadata helpers."""
