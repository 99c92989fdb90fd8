"""Reading landed articles and writing results."""
