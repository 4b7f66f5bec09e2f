"""Writers: messages, cells, documents, task history, and the change cursor."""
