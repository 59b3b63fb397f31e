"""keelson.streaming"""
