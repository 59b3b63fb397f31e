"""keelson.functions"""
